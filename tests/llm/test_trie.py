import math

from tests.llm.conftest import hostile, prose
from tillstar.llm import trie


def brute(text, scores):
    """Words and tokens, each word by itself: best (score, fewest tokens) over all segmentations."""
    words = (text or "").encode().split()
    total = 0
    for w in words:
        path = trie.MARK + w.decode()
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(path)
        for i in range(1, len(path) + 1):
            size = len(path[i - 1].encode())
            options = [(best[i - 1][0] + trie.BYTE * size, -(best[i - 1][1] + size))]
            options += [(best[j][0] + scores[path[j:i]], -(best[j][1] + 1)) for j in range(max(0, i - 20), i) if path[j:i] in scores]
            top = max(options)
            best[i] = (top[0], -top[1])
        total += best[-1][1]
    return len(words), total


def test_counts_equal_plain_segmentation(spark, documents, no_documents):
    scores = trie.vocabulary()
    got = sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in trie.token_counts(documents).collect())
    texts = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert got == sorted((str(i), *brute(t, scores)) for i, t in texts)
    assert trie.token_counts(no_documents).count() == 0


def test_same_as_the_library_model():
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    scores = trie.vocabulary()
    model = Tokenizer(Unigram([("<unk>", -1e4), *scores.items()], unk_id=0))
    counter = trie.Counter(scores)
    words = sorted({w for _, t, *_ in hostile() for w in (t or "").split() if len(w) < 200} | set("hello unigram tokenisation trees international".split()))
    known = [w for w in words if all(c in scores for c in w)]
    assert len(known) > 100
    assert [n for _, n in counter.of(known)] == [len(model.encode(trie.MARK + w).ids) for w in known]


def test_shared_prefixes_are_scored_once():
    counter = trie.Counter(trie.vocabulary())
    words = "inter internal international internationally".split()
    counter.of([" ".join(words)])
    assert counter.nodes == len({(trie.MARK + w)[:k] for w in words for k in range(1, len(w) + 2)})
    counter.of([prose(1, 50)] * 2)
    nodes = counter.nodes
    counter.of([prose(1, 50)])
    assert counter.nodes == nodes
