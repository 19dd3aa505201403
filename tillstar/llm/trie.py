"""Token counts under a unigram model by dynamic programming that shares prefixes.

A text is its words, each with the word mark before it. A task puts the distinct words of some hundred documents
into a trie, walked depth first by taking the words in order: the forward scores of a prefix that the last word had too
stay where they are, so every trie node is scored once. A word's count is read at its end node and kept for the
documents that hold the word. No rows are exchanged.

The pieces come from a public vocabulary file; nothing is trained. A piece's score is the logarithm of a Zipf law over its
rank, ``-log(rank + 2)``; characters that are no piece cost ``BYTE`` for each of their UTF-8 bytes. Of equally likely
segmentations the one with fewer tokens counts.

Defined results: null or empty text has zero words and tokens; rows with a null or repeated ``doc_id`` count like any row; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
BYTE = -20.0
STEP = 256
LIMIT = 400_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str | None = None) -> dict[str, float]:
    """Piece to score; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {model.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(plain)}


class Counter:
    """Counts of words, kept until there are ``LIMIT``; then they are computed anew as they come."""

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest = scores, max(map(len, scores), default=1)
        self.known: dict[str, int] = {}
        self.nodes = 0  # trie nodes scored so far

    def learn(self, words: set[str]) -> None:
        if len(self.known) > LIMIT:
            self.known.clear()
        best, count = [0.0], [0]  # forward score and tokens up to each character of the current path
        last = ""
        scores, longest = self.scores, self.longest
        for word in sorted(w for w in words if w not in self.known):
            path = MARK + word
            shared = 0
            for a, b in zip(last, path):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for i in range(shared + 1, len(path) + 1):
                size = len(path[i - 1].encode("utf-8", "surrogatepass"))
                top, tokens = best[i - 1] + BYTE * size, count[i - 1] + size
                for j in range(max(0, i - longest), i):
                    score = scores.get(path[j:i])
                    if score is not None:
                        score += best[j]
                        if score > top or (score == top and count[j] + 1 < tokens):
                            top, tokens = score, count[j] + 1
                best.append(top)
                count.append(tokens)
            self.nodes += len(path) - shared
            self.known[word] = count[-1]
            last = path

    def of(self, texts: list[str]) -> list[tuple[int, int]]:
        """(words, tokens) of each text."""
        words = [x.decode("utf-8", "surrogatepass").split("\n") if (x := b"\n".join(t.encode("utf-8", "surrogatepass").split())) else [] for t in texts]
        self.learn(set().union(*words))
        get = self.known.__getitem__
        return [(len(w), sum(map(get, w))) for w in words]


def token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens per document; the vocabulary (some 32,000 pieces) is broadcast."""
    scores = documents.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        counter = Counter(scores.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = [r for k in range(0, len(texts), STEP) for r in counter.of(texts[k : k + STEP])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1))], ["doc_id", "n_words", "n_tokens"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
