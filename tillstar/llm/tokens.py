"""Token ids of whole texts with the tokenizers library, inside Arrow tasks.

Texts repeat words, so a run of texts becomes a dictionary of its words and an index per word, both made by Arrow; only the
dictionary is encoded, and the ids are gathered by index. A text is cut before a blank that stands between two characters that are no
white space; byte-level pre-tokens never cross such a place, so the words' ids joined are the text's ids. A text with other
white space, or blanks in a row, is encoded as a whole, and so is every text where the tokenizer is no plain byte-level one.
"""

from __future__ import annotations

import os
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

END = 0
#: White space other than the blank and the line feed.
_ODD = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Below it, what is a letter or a digit is the same in all versions of Unicode.
_SETTLED = "\u0250"
#: Marks that behind letters make one pre-token of their own; the apostrophe may begin an ending such as 's.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: Ids from which on a pre-token is not kept, so that the store is bounded by its entries.
LONG_STEM = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def shared_tokenizer(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The tokenizer's file (1.5 MB), read by the driver, so executors need no such file."""
    with open(path or default_path(), encoding="utf-8") as source:
        return spark.sparkContext.broadcast(source.read())


#: A blank that does not stand between two characters that are no white space, but for one at the end.
_UNPLAIN = "^ |  |\n |[" + _ODD + "]"
_UNSETTLED = f"[{_SETTLED}-\U0010ffff]"


class Encoder:
    """Texts to little-endian ids of ``kind``, two bytes each if the vocabulary allows, else four.

    Words mostly differ in marks around a few stems, so the ids of stems are kept; the store is emptied when full. Texts
    are taken in runs of at most ``RUN`` bytes, but for a longer text, which is a run of its own.
    """

    STEMS = 300_000
    RUN = 16 << 20

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True  # control strings inside a text are ordinary text
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cut = regex.compile(PATTERN).findall
        self.model = self.tokenizer.model
        split = self.tokenizer.pre_tokenizer
        self.by_words = self.tokenizer.normalizer is None and isinstance(split, pre_tokenizers.ByteLevel) and not split.add_prefix_space and split.use_regex
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {n: "".join(p for p, _ in as_bytes.pre_tokenize_str(chr(n))) for n in range(ord(_SETTLED))}
        self.stems: dict[str, bytes] = {}
        self.packs = [struct.Struct(f"<{n}{self.kind.char}").pack for n in range(LONG_STEM)]

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, stem: str) -> bytes:
        """Ids of one pre-token of settled characters, kept unless there are very many."""
        ids = [t.id for t in self.model.tokenize(stem.translate(self.shown))]
        if (n := len(ids)) < LONG_STEM:
            found = self.stems[stem] = self.packs[n](*ids)
            return found
        return np.array(ids, self.kind).tobytes()

    def _words(self, words: pa.Array, before: str) -> list[bytes]:
        """Ids of each word with ``before`` in front of it."""
        odd = pc.match_substring_regex(words, _UNSETTLED).to_numpy(zero_copy_only=False).tolist()
        given, known, learn, out = words.to_pylist(), self.stems.get, self._learn, []
        for w, unsettled in zip(given, odd):
            if unsettled or not w:
                out.append(b"")
            elif w.isalpha():
                out.append(known(w := before + w) or learn(w))
            elif (stem := w.rstrip(_MARKS)).isalpha():
                marks, stem = w[len(stem):], before + stem
                out.append((known(stem) or learn(stem)) + (known(marks) or learn(marks)))
            else:
                out.append(b"".join([known(s) or learn(s) for s in self.cut(before + w)]))
        left = [k for k, w in enumerate(given) if odd[k] or not w]
        for k, ids in zip(left, self._raw([before + given[k] for k in left])):
            out[k] = ids
        return out

    def _run(self, texts: pa.Array) -> pa.Array:
        if len(self.stems) > self.STEMS:
            self.stems.clear()
        end = np.array([END], self.kind).tobytes()
        whole = pc.match_substring_regex(texts, _UNPLAIN).to_numpy(zero_copy_only=False) if self.by_words else np.ones(len(texts), bool)
        alone = np.flatnonzero(whole)
        # A text encoded as a whole stands here as one empty word, whose code is its own entry.
        cut = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        coded = cut.flatten().dictionary_encode()
        at = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        codes = coded.indices.to_numpy().astype(np.int64)
        firsts = coded.dictionary.take(pa.array(codes[at[:-1]])).dictionary_encode()
        codes[at[:-1]] = len(coded.dictionary) + firsts.indices.to_numpy()
        used = np.zeros(len(coded.dictionary), bool)
        used[codes[codes < len(used)]] = True
        entries = np.full(len(used), b"", object)
        entries[used] = self._words(coded.dictionary.filter(pa.array(used)), " ")
        own = self._raw(texts.take(pa.array(alone)).to_pylist())
        codes[at[alone]] = len(used) + len(firsts.dictionary) + np.arange(len(alone))
        table = pa.array([*entries.tolist(), *self._words(firsts.dictionary, ""), *own, end], pa.large_binary())
        codes = np.insert(codes, at[1:], len(table) - 1)
        taken = table.take(pa.array(codes))
        places = np.frombuffer(taken.buffers()[1], np.int64)[: len(codes) + 1]
        offsets = places[at + np.arange(len(at))]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets), taken.buffers()[2]])

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """Ids of each text, null as empty, with the end id behind them."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        runs, a = [], 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + self.RUN, side="right")))
            runs.append(self._run(texts.slice(a, b - a)))
            a = b
        return pa.concat_arrays(runs) if runs else pa.array([], pa.large_binary())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """:meth:`encode_column` for a list."""
        return self.encode_column(pa.array(texts, pa.large_string())).to_pylist()


_workers: dict[str, Encoder] = {}


def worker_encoder(content: str) -> Encoder:
    """The encoder of this Python worker, with what it has learned in earlier tasks; at most one is kept."""
    if content not in _workers:
        _workers.clear()
        pa.default_memory_pool().release_unused()  # what other operators' tasks left in this worker
        _workers[content] = Encoder(content)
    return _workers[content]


def release() -> None:
    """Drop the encoder that this worker has kept; for tasks of other operators, which need the memory for their own."""
    _workers.clear()


def kind_of(content: str) -> np.dtype:
    return Encoder(content).kind


def wide(ids: bytes, kind: np.dtype) -> bytes:
    """The same ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, kind).astype("<u4").tobytes()
