"""Language identification by unigram pieces, summed over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word is the sum over
all ways to cut it into pieces, by a forward algorithm; a text's is the product over its words. The language with the
largest wins, and the score is its posterior under equal priors. The probabilities are learned by expectation
maximisation, whose expected counts come from the same sums (forward and backward).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwise.llm.arrow import mix, text_chunks, word_hashes, words
from basketwise.llm.bpe import _byte_letters
from basketwise.session import materialise

UNIT = 24  # words of up to so many bytes are scored side by side, longer ones one by one
_PAD = 24
_SMOOTH = 0.01
_SLICE = 1 << 12  # words whose forward sums a task holds at once


class Pieces:
    """The vocabulary's pieces: as one sorted table per length for short words, and by their bytes."""

    def __init__(self, path: str) -> None:
        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        found = sorted({bytes(letters[c] for c in token) for token in vocabulary if all(c in letters for c in token)} | {bytes([b]) for b in range(256)})
        self.count = len(found)
        self.ids = {p: i for i, p in enumerate(found)}
        self.lengths = sorted({len(p) for p in found})
        self.tables = {}
        for n in self.lengths:
            if n > UNIT + 1:
                continue
            own = [p for p in found if len(p) == n]
            raw = np.frombuffer(b"".join(p.ljust(_PAD + 1, b"\0") for p in own), np.uint8).reshape(-1, _PAD + 1)
            keys = self._keys([np.ascontiguousarray(raw[:, i : i + 8]).view("<u8")[:, 0] for i in (0, 8, 16)] + [raw[:, 24].astype(np.uint64)], n)
            order = np.argsort(keys)
            self.tables[n] = keys[order], np.array([self.ids[p] for p in own], dtype=np.int64)[order]

    @staticmethod
    def _keys(loads: list[np.ndarray], n: int) -> np.ndarray:
        """The first ``n`` bytes of each row as one number: their value up to 8 bytes, a hash beyond."""
        key = np.zeros(len(loads[0]), np.uint64)
        for i, load in enumerate(loads[: -(-n // 8)]):
            rest = min(8, n - 8 * i)
            part = load & np.uint64((1 << 8 * rest) - 1)
            key = part if i == 0 else mix(key) + part * np.uint64(0x9E3779B97F4A7C15)
        return key

    def at(self, loads: list[np.ndarray], n: int) -> np.ndarray:
        """Ids of the ``n``-byte pieces at the start of rows of 8-byte loads; ``count`` where there is none."""
        keys, ids = self.tables[n]
        wanted = self._keys(loads, n)
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[place] == wanted, ids[place], self.count)


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every word."""
    starts, ends, first = words(data, offsets)
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(first))


def _matrix(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most ``UNIT`` bytes as rows of bytes with a space before them, lower-cased in A-Z, and their lengths."""
    at = low[:, None] + np.arange(UNIT)
    inside = at < high[:, None]
    letters = np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
    letters[(letters >= 65) & (letters <= 90)] += 32
    rows = np.zeros((len(low), 1 + UNIT + _PAD + 8), np.uint8)
    rows[:, 0] = 32
    rows[:, 1 : 1 + UNIT] = letters
    return rows, high - low + 1


def _loads(rows: np.ndarray) -> list[np.ndarray]:
    """The eight bytes from each position of every row, as integers."""
    return [np.ascontiguousarray(rows[:, i : i + 8]).view("<u8")[:, 0] for i in range(1 + UNIT + _PAD)]


def _found(table: Pieces, loads: list[np.ndarray], start: int, n: int, active: int = 0) -> np.ndarray:
    return table.at([loads[start + 8 * i][active:] for i in range(-(-n // 8))], n)


def _forward(rows: np.ndarray, lengths: np.ndarray, table: Pieces, chance: np.ndarray) -> np.ndarray:
    """Probability of each short word per language; ``chance``: (pieces + 1) x languages, the last row 0."""
    order = np.argsort(lengths, kind="stable")
    rows, lengths = rows[order], lengths[order]
    loads = _loads(rows)
    reached = np.zeros((UNIT + 2, len(rows), chance.shape[1]))
    reached[0] = 1
    for end in range(1, int(lengths[-1]) + 1 if len(rows) else 1):
        active = np.searchsorted(lengths, end)  # shorter words come first
        for n in table.tables:
            if n > end:
                break
            ids = _found(table, loads, end - n, n, active)
            if n <= 8:
                reached[end, active:] += reached[end - n, active:] * chance[ids]
            else:  # few words have a long piece
                hit = np.flatnonzero(ids < table.count)
                reached[end, active + hit] += reached[end - n, active + hit] * chance[ids[hit]]
    out = np.empty((len(rows), chance.shape[1]))
    out[order] = reached[lengths, np.arange(len(rows))]
    return out


def _forward_long(word: bytes, table: Pieces, chance: np.ndarray) -> np.ndarray:
    """Logarithm of one word's probability per language. The sums of the last positions are kept as logarithms, as many as the
    longest piece has bytes, so a word may be as long as it likes."""
    word = b" " + word.translate(_LOWER_BYTES)
    keep = table.lengths[-1] + 1
    ring = np.full((keep, chance.shape[1]), -np.inf)
    ring[0] = 0
    for end in range(1, len(word) + 1):
        ways = []
        for n in table.lengths:
            if n > end:
                break
            found = table.ids.get(word[end - n : end])
            if found is not None:
                ways.append(ring[(end - n) % keep] + np.log(chance[found]))
        ring[end % keep] = np.logaddexp.reduce(ways)
    return ring[len(word) % keep]


_LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _log_chances(data: np.ndarray, low: np.ndarray, high: np.ndarray, table: Pieces, chance: np.ndarray) -> np.ndarray:
    """Logarithm of each word's probability per language."""
    logs = np.empty((len(low), chance.shape[1]))
    short = np.flatnonzero(high - low <= UNIT)
    for i in range(0, len(short), _SLICE):
        part = short[i : i + _SLICE]
        logs[part] = np.log(_forward(*_matrix(data, low[part], high[part]), table, chance))
    for i in np.flatnonzero(high - low > UNIT).tolist():
        logs[i] = _forward_long(data[low[i] : high[i]].tobytes(), table, chance)
    return logs


def _expected(rows: np.ndarray, lengths: np.ndarray, weights: np.ndarray, table: Pieces, chance: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words, for one language."""
    loads = _loads(rows)
    top = int(lengths.max())
    ahead, back = np.zeros((top + 1, len(rows))), np.zeros((top + 1, len(rows)))
    ahead[0] = 1
    back[lengths, np.arange(len(rows))] = 1
    steps = [(end, n, _found(table, loads, end - n, n)) for end in range(1, top + 1) for n in table.tables if n <= end]
    for end, n, ids in steps:
        ahead[end] += ahead[end - n] * chance[ids]
    for end, n, ids in reversed(steps):
        back[end - n] += back[end] * chance[ids]
    scale = weights / back[0]
    out = np.zeros(table.count + 1)
    for end, n, ids in steps:
        out += np.bincount(ids, ahead[end - n] * chance[ids] * back[end] * scale, table.count + 1)
    return out[:-1]


def fit(docs: DataFrame, vocabulary: str, *, text: str = "text", lang: str = "lang", order: str = "doc_id",
        rows: int = 400, most: int = 16384, rounds: int = 3) -> dict[str, np.ndarray]:
    """Piece probabilities per language.

    Learned on a bounded sample: per language the ``rows`` labelled texts of at most ``most`` bytes whose ``order`` has the
    smallest hashes, and of these the words of at most ``UNIT`` bytes. Rows without label or text are not used. Only one vector per language reaches the driver.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.octet_length(text) <= most))
    rank = F.row_number().over(Window.partitionBy("__lang").orderBy(F.xxhash64("__id"), "__id"))
    ids = known.select(F.col(lang).alias("__lang"), F.col(order).alias("__id")).withColumn("__rank", rank).where(F.col("__rank") <= rows)
    ids = materialise(ids.select("__lang", "__id"), "langid-sample").distinct()
    chosen = known.select(F.col(order).alias("__id"), F.col(lang).alias("__lang"), F.col(text).alias("__text")).join(
        F.broadcast(ids), ["__id", "__lang"]  # rows per language at most
    )

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        table = pieces(vocabulary)
        chance = np.append(np.full(table.count, 1 / table.count), 0)
        rows_, sizes_, hashes_, counts_ = [], [], [], []
        for _, _, block, offsets in text_chunks(pa.array(frame["__text"], pa.string())):
            low, high, _ = _units(block, offsets)
            short = high - low <= UNIT
            low, high = low[short], high[short]
            if len(low):  # each word of a chunk once, then each of all chunks
                values, first, many = np.unique(word_hashes(block, low, high, lower=True), return_index=True, return_counts=True)
                row, size = _matrix(block, low[first], high[first])
                for held, part in zip((rows_, sizes_, hashes_, counts_), (row, size, values, many)):
                    held.append(part)
        if rows_:
            _, first, which = np.unique(np.concatenate(hashes_), return_index=True, return_inverse=True)
            weights = np.bincount(which, np.concatenate(counts_))
            row, size = np.concatenate(rows_)[first], np.concatenate(sizes_)[first]
            for _ in range(rounds):
                counts = sum(
                    _expected(row[i : i + _SLICE], size[i : i + _SLICE], weights[i : i + _SLICE], table, chance)
                    for i in range(0, len(row), _SLICE)
                )
                counts += _SMOOTH
                chance[:-1] = counts / counts.sum()
        return pd.DataFrame({"lang": [frame["__lang"].iloc[0]], "chance": [chance.tobytes()]})

    models = chosen.groupBy("__lang").applyInPandas(learn, "lang string, chance binary").collect()
    return {m["lang"]: np.frombuffer(m["chance"]) for m in sorted(models, key=lambda m: m["lang"])}


def predict(docs: DataFrame, model: dict[str, np.ndarray], vocabulary: str, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    A null text, and one without a letter, gets ``und`` and 0, and so does every text if nothing was learned. Ties go to the
    first language by name. Columns of ``docs`` with these two names are replaced; rows are kept as they are.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = sorted(model)
    chance = np.stack([model[n] for n in names], axis=1) if names else np.zeros((1, 0))
    out = T.StructType([*kept, T.StructField("__best", T.StringType()), T.StructField("__score", T.DoubleType())])
    place = [f.name for f in kept].index(text)

    def scores(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        table = pieces(vocabulary)
        for low, high, data, offsets in text_chunks(column):
            total = np.zeros((high - low, len(names)))
            starts, ends, owner = _units(data, offsets)
            if len(starts):
                _, first, which = np.unique(word_hashes(data, starts, ends, lower=True), return_index=True, return_inverse=True)
                logs = _log_chances(data, starts[first], ends[first], table, chance)
                for k in range(len(names)):
                    total[:, k] = np.bincount(owner, logs[which, k], high - low)
            best = total.argmax(axis=1)
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            yield best, odds.max(axis=1) / odds.sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(scores(batch.column(place)))
            if not found:
                continue
            best, score = (np.concatenate(x) for x in zip(*found))
            columns = [*batch.columns, pa.array([names[b] for b in best], pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    plain = docs.select(*[f"`{f.name}`" for f in kept])
    if names:
        scored = plain.mapInArrow(run, out)
    else:
        scored = plain.withColumns({"__best": F.lit("und"), "__score": F.lit(0.0)})
    sure = F.coalesce(F.col(f"`{text}`").rlike("\\p{L}"), F.lit(False))
    return scored.select(
        *[f"`{f.name}`" for f in kept],
        F.when(sure, F.col("__best")).otherwise(F.lit("und")).alias("lang_pred"),
        F.when(sure, F.col("__score")).otherwise(F.lit(0.0)).alias("score"),
    )
