"""Byte-level BPE by dynamic programming over prefixes, and its inverse.

A text is cut into pre-tokens by the vocabulary's public pattern. Within one, every prefix has exactly one last token
in its BPE encoding: among the tokens that end there (found for all ends in one pass of an
Aho-Corasick automaton over the tokens, which takes the place of a suffix automaton: it is built once, not per text), it is the
one that is compatible with the last token of the prefix before it. Storing it per prefix and following the pointers
back from the end gives the ids, in time linear in the length.

Two tokens are compatible when merging their joined bytes gives the two again. Undoing their merges from the last one
back shows every pair that ever met at the border; none of these may merge earlier than the merge that replaced it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: fixed value: the pre-token pattern of byte-level vocabularies of this kind
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_KEPT = 200_000  # pre-tokens remembered by a worker, in each of two generations
_LONG = 64  # longer pre-tokens are not remembered
_ROWS = 256


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for themselves, the rest from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """One vocabulary: encodes texts to ids and ids to texts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        ids = spec["model"]["vocab"]
        raw = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw |= {i: text.encode() for text, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = ids[left], ids[right]
            self.rank[a, b] = rank
            self.parts.setdefault(ids[left + right], (rank, a, b))
        self.matches = ahocorasick.Automaton()
        for token, i in ids.items():
            if len(token) == 1 or i in self.parts:
                text = raw[i].decode("latin-1")
                self.matches.add_word(text, (len(text), i))
        self.matches.make_automaton()
        self.cut = regex.compile(PATTERN)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        size = max(raw) + 1
        self.length = np.array([len(raw.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.bytes = np.frombuffer(b"".join(raw.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        a, b, limit, verdict = left, right, len(self.rank) + 1, None
        while verdict is None:
            if self.rank.get((a, b), limit) < limit:
                verdict = False
                break
            made_a, made_b = self.parts.get(a), self.parts.get(b)
            if made_a is None and made_b is None:
                verdict = True
            elif made_b is None or made_a is not None and made_a[0] > made_b[0]:
                limit, a = made_a[0], made_a[2]  # of equal merges the left one comes first
            else:
                limit, b = made_b[0] + 1, made_b[1]
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        self.pairs[left, right] = verdict
        return verdict

    def word_ids(self, word: str) -> bytes:
        """Ids of one pre-token, as the bytes of 32-bit integers."""
        text = word.encode("utf-8").decode("latin-1")
        last = [-1] * (len(text) + 1)
        fits = self.compatible
        for end, (length, token) in self.matches.iter(text):
            if last[end + 1] < 0:
                before = end + 1 - length
                if before == 0 or last[before] >= 0 and fits(last[before], token):
                    last[end + 1] = token
        out, at, length = [], len(text), self.length
        while at:
            out.append(last[at])
            at -= int(length[last[at]])
        return np.array(out[::-1], dtype=np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        out = []
        for piece in self.marks.split(text) if self.marks and any(m in text for m in self.special) else (text,):
            if piece in self.special:
                out.append(np.int32(self.special[piece]).tobytes())
                continue
            for word in self.cut.findall(piece):
                ids = self.young.get(word)
                if ids is None:
                    ids = self.old.get(word) or self.word_ids(word)
                    if len(word) <= _LONG:
                        if len(self.young) >= _KEPT:
                            self.old, self.young = self.young, {}
                        self.young[word] = ids
                out.append(ids)
        return b"".join(out)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of several rows of ids; bytes that are no UTF-8 become replacement characters."""
        length = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(length)])
        at = np.arange(ends[-1]) + np.repeat(self.start[ids] - ends[:-1], length)
        data = self.bytes[at].tobytes()
        edges = ends[offsets]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(edges, edges[1:])]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The vocabulary of a file, read once by a worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (its texts encoded) and ``decoded`` (these ids decoded).

    Args:
        vocabulary: path of a byte-level BPE file that every executor has.
        text: name of the text column. A null or empty text gets no ids and an empty decoded text.

    Columns of ``df`` that are called ``ids`` or ``decoded`` are replaced; all other columns and all rows, repeated
    ones too, are kept. Added tokens of the vocabulary that occur in a text become their own id.
    """
    kept = [f for f in df.schema.fields if f.name not in ("ids", "decoded")]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    place = [f.name for f in kept].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for whole in batches:
            for low in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(low, _ROWS)
                rows = [coder.encode(t) if t else b"" for t in batch.column(place).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
                ids = np.frombuffer(b"".join(rows), dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                back = pa.array(coder.decode(ids, offsets), pa.string())
                names = [f.name for f in kept] + ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, back], names=names)

    return df.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, T.StructType(kept + added))
