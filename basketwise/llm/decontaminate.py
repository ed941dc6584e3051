"""Benchmark passages in documents, by latent semantic retrieval and exact checks.

1. Statistics: how many passages (``SPAN`` words) have each hashed word, over all documents.
2. Index: a randomised singular value decomposition of the TF-IDF passages of all documents and of the benchmark. Random directions
   are multiplied with the passages' covariance three times, each time as sums over tasks; only matrices of the size of the hashed
   vocabulary times the rank reach the driver. The passages' features are stored once, as two bytes a word.
3. Search: every passage of every document, overlapping by half, is folded into the latent space and compared by cosine
   with all items' parts of ``SPAN`` words. Items of less than ``HALF`` words are looked for in all places instead.
4. Checks: of an item's rarest words, one more than it may miss, one must be near the place, and so must enough of all its words.
   Around each other candidate the longest common subsequence of words with the item, and that with its answer (the item's last
   sentence), must reach their parts of the item. The two conditions follow from the parts, so they drop nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwise.llm.arrow import text_chunks, word_hashes, words
from basketwise.session import materialise

FEATURES = 1 << 13
RANK = 64
HALF = 16  # words between passages
SPAN = 2 * HALF
SAMPLE = 1 << 12  # passages that a task multiplies at once; all are, one block after another
_STORED = 1 << 8  # passages in a stored row
_PIECE = 32  # words of a feature that are added up side by side
_ITEMS = 4 << 20  # bytes of items per block
_MOST = 1 << 14  # items per block
_DENSE = 64  # passages whose rows are computed at once, as wider numbers
_STRETCHES = 256  # candidates of an item whose words are counted at once
_EDGE = np.zeros(256, dtype=bool)
_EDGE[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words without punctuation around them, and the first word of each text."""
    starts, ends, first = words(data, offsets)
    for at, step in ((starts, 1), (ends, -1)):  # a word of punctuation alone keeps one sign
        some = np.arange(len(at))
        while len(some):
            some = some[_EDGE[data[at[some] - (step < 0)]] & (ends[some] - starts[some] > 1)]
            at[some] += step
    return word_hashes(data, starts, ends, lower=True), first


def _of_text(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return word_ids(data, np.array([0, len(data)]))[0]


def _cuts(first: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every run of ``step`` words, and its text."""
    runs = -(-np.diff(first) // step)
    text = np.repeat(np.arange(len(runs)), runs)
    place = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    return first[text] + place * step, text


def _feature(ids: np.ndarray) -> np.ndarray:
    return (ids % np.uint64(FEATURES)).astype(np.int64)


def _statistics(texts: DataFrame) -> DataFrame:
    """Rows of passages, as ``SPAN`` features each in rising order (``FEATURES``: none), and per task how many passages have each (counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                ids, first = word_ids(data, offsets)
                if not len(ids):
                    continue
                starts, _ = _cuts(first, SPAN)
                lengths = np.diff(np.append(starts, len(ids)))
                kind = np.uint32 if len(starts) * FEATURES < 1 << 32 else np.uint64
                keys = np.repeat(np.arange(len(starts), dtype=kind) * kind(FEATURES), lengths) + _feature(ids).astype(kind)
                keys.sort()
                fresh = np.ones(len(keys), bool)
                fresh[1:] = keys[1:] != keys[:-1]
                held = (keys % kind(FEATURES)).astype(np.uint16)
                seen += np.bincount(held[fresh], minlength=FEATURES)
                total += len(starts)
                passages = np.full((len(starts), SPAN), FEATURES, np.uint16)
                passages[np.arange(SPAN) < lengths[:, None]] = held
                rows = [passages[i : i + _STORED].tobytes() for i in range(0, len(starts), _STORED)]
                yield pa.RecordBatch.from_pydict({"passages": pa.array(rows, pa.binary()), "counts": pa.nulls(len(rows), pa.binary())})
        counts = np.append(seen, total).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([counts], pa.binary())], names=["passages", "counts"])

    return texts.mapInArrow(run, "passages binary, counts binary")


def _summed(parts: DataFrame, column: str, kind: type, width: int) -> np.ndarray:
    """Sum of packed vectors of ``width`` numbers: per task first, then by slices of the vector, which are small."""
    slices = 16

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, kind)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(data, kind)
        pieces = [p.tobytes() for p in np.array_split(total, slices)]
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(slices), pa.int32()), "data": pa.array(pieces, pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(*(c.to_pylist() for c in batch.columns)):
                sums[piece] = sums.get(piece, 0) + np.frombuffer(data, kind)
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array(list(sums), pa.int32()), "data": pa.array([s.tobytes() for s in sums.values()], pa.binary())}
        )

    schema = "slice int, data binary"
    rows = parts.select(column).mapInArrow(cut, schema).repartition(slices, "slice").mapInArrow(add, schema).collect()
    found = {r["slice"]: np.frombuffer(r["data"], kind) for r in rows}
    return np.concatenate([found[i] for i in range(slices)]) if found else np.zeros(width, kind)


def _dense(packed: list[bytes], idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length, some at a time: only the result is whole."""
    out = np.empty((len(packed), FEATURES), np.float32)
    for low in range(0, len(packed), _DENSE):
        part = packed[low : low + _DENSE]
        at = np.repeat(np.arange(len(part)), [len(p) // 2 for p in part]) * FEATURES + np.frombuffer(b"".join(part), np.int16)
        rows = np.bincount(at, minlength=len(part) * FEATURES).reshape(len(part), FEATURES) * idf
        length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        out[low : low + _DENSE] = rows / np.where(length > 0, length, 1)
    return out


def _group_sums(values: np.ndarray, at: np.ndarray, first: np.ndarray, room: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sum of ``values[at]`` over each run of places from ``first`` on; pieces of runs are added side by side, the longest first.

    ``room``: two arrays of rows to work in, enough for all pieces.
    """
    sizes = np.diff(np.append(first, len(at)))
    pieces = -(-sizes // _PIECE)
    of = np.cumsum(pieces) - pieces
    begin = np.repeat(first, pieces) + _PIECE * (np.arange(pieces.sum()) - np.repeat(of, pieces))
    size = np.minimum(np.repeat(first + sizes, pieces) - begin, _PIECE)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    sums, more = (x[: len(begin)] for x in room)
    np.take(values, at[begin], axis=0, out=sums, mode="clip")  # the default mode copies
    for j in range(1, int(size[0])):
        longer = int(np.searchsorted(-size, -j, side="left"))
        sums[:longer] += np.take(values, at[begin[:longer] + j], axis=0, out=more[:longer], mode="clip")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    out = np.take(sums, back[of], axis=0, out=more[: len(of)], mode="clip")
    several = np.flatnonzero(pieces > 1)
    if len(several):
        many = pieces[several]
        start = np.cumsum(many) - many
        out[several] = np.add.reduceat(sums[back[np.repeat(of[several] - start, many) + np.arange(many.sum())]], start, axis=0)
    return out


def _room(rank: int) -> tuple[np.ndarray, ...]:
    """Arrays that ``_add_covariance`` works in: new ones would be fresh memory for every block."""
    rows = (SAMPLE, SAMPLE, SAMPLE * SPAN // _PIECE + FEATURES, SAMPLE * SPAN // _PIECE + FEATURES)
    return tuple(np.empty((n, rank), np.float32) for n in rows)


def _add_covariance(total: np.ndarray, passages: np.ndarray, weights: np.ndarray, directions: np.ndarray, room: tuple[np.ndarray, ...]) -> None:
    """Adds to ``total`` the covariance of at most ``SAMPLE`` rows of features times ``directions``.

    ``weights`` and ``directions`` (already weighed) end with a zero for places without a word.
    """
    squares = weights * weights
    length2 = squares[passages].sum(axis=1)
    rows, held = np.arange(len(passages)), passages
    for lag in range(1, passages.shape[1]):  # a feature n times counts n * n, and stands beside itself
        same = held[:, lag:] == held[:, :-lag]
        same &= held[:, lag:] < FEATURES
        some = np.flatnonzero(same.any(axis=1))
        if not len(some):
            break
        rows, held = rows[some], held[some]
        length2[rows] += 2 * (squares[held[:, lag:]] * same[some]).sum(axis=1)
    folded, word = (x[: len(passages)] for x in room[:2])
    places = np.ascontiguousarray(passages.T).astype(np.int64)
    np.take(directions, places[0], axis=0, out=folded, mode="clip")
    for at in places[1:]:
        folded += np.take(directions, at, axis=0, out=word, mode="clip")
    folded /= np.where(length2 > 0, length2, 1)[:, None].astype(directions.dtype)  # once for each factor
    flat = passages.ravel()
    order = np.argsort(flat, kind="stable")[: int(np.count_nonzero(flat < FEATURES))]
    held = flat[order]
    if len(held):
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        found = held[first]
        total[found] += weights[found, None] * _group_sums(folded, order // passages.shape[1], first, room[2:])


def _covariance(parts: DataFrame, whole: DataFrame, idf: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The covariance of stored passages and of ``whole``, rows of features of any length, times ``directions``."""
    shape = directions.shape
    weights = np.append(idf, 0.0)
    weighed = np.vstack([directions * idf[:, None], np.zeros((1, shape[1]))]).astype(np.float32)
    narrow = directions.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = np.zeros(shape, np.float64), _room(shape[1])
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16).reshape(-1, SPAN)
            for i in range(0, len(held), SAMPLE):
                _add_covariance(total, held[i : i + SAMPLE], weights, weighed, room)
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    def run_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.float64)
        for batch in batches:
            packed = batch.column(0).to_pylist()
            for i in range(0, len(packed), 512):
                rows = _dense(packed[i : i + 512], idf)
                total += rows.T @ (rows @ narrow)
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    sums = parts.where("passages is not null").select("passages").mapInArrow(run, "part binary").unionByName(whole.mapInArrow(run_whole, "part binary"))
    return _summed(sums, "part", np.float64, shape[0] * shape[1]).reshape(shape)


def latent_words(texts: DataFrame, benchmark: DataFrame, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Latent vector of each feature, its weight in the singular directions, each scaled to unit variance; and how rare it is.

    A passage has length 1. Directions that carry less than one passage's square are not scaled up: where passages are few, that would make each
    one stand at right angles to all others, copies with a few more words among them.
    """
    parts = materialise(_statistics(texts), "latent-passages")
    counts = _summed(parts.where("counts is not null"), "counts", np.int64, FEATURES + 1)
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_feature(_of_text(t or "")).astype(np.int16).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"words": pa.array(packed, pa.binary())})

    whole = materialise(benchmark.select("text").mapInArrow(pack, "words binary"), "latent-benchmark")
    basis = np.random.default_rng(seed).standard_normal((FEATURES, RANK))
    for _ in range(2):
        basis, _ = np.linalg.qr(_covariance(parts, whole, idf, basis))
    power, turn = np.linalg.eigh(basis.T @ _covariance(parts, whole, idf, basis))
    strong = power > max(power.max(), 0) * 1e-9
    scaled = basis @ turn[:, strong] / np.sqrt(power[strong] + 1) if strong.any() else np.zeros((FEATURES, 1))
    return (scaled * idf[:, None]).astype(np.float32), idf


class Item:
    """A benchmark item as bit masks of its words, for subsequences."""

    def __init__(self, item_id: int | None, text: str) -> None:
        self.id = item_id
        self.words = _of_text(text).tolist()
        ended = [m.end() for m in re.finditer(r"[.?!]\s", text.rstrip() + " ")]
        tail = text[ended[-2] :] if len(ended) > 1 and ended[-1] >= len(text.rstrip()) else text[ended[-1] :] if ended else text
        self.answer = _of_text(tail).tolist() or self.words
        self.masks, self.answer_masks = self._masks(self.words), self._masks(self.answer)

    @staticmethod
    def _masks(ids: list[int]) -> dict[int, int]:
        masks: dict[int, int] = {}
        for i, word in enumerate(ids):
            masks[word] = masks.get(word, 0) | 1 << i
        return masks


def subsequence(masks: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence of ``text`` and the ``size`` words behind ``masks``."""
    full = (1 << size) - 1
    state = full
    for word in text:
        mask = masks.get(word)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def _checked(item: Item, ids: np.ndarray, low: int, high: int, least: float, answer: float) -> tuple[int, float] | None:
    """Best subsequence with the item in stretches of one and a half times its length, if item and answer reach their parts."""
    size = len(item.words)
    low, high = max(0, low - size), min(len(ids), high + size)
    region = ids[low:high].tolist()
    best: tuple[int, float] | None = None
    span, step = size + size // 2 + 1, size // 4 + 1
    for start in range(0, max(1, len(region) - span + step), step):
        part = region[start : start + span]
        if sum(w in item.masks for w in part) < least * size:
            continue
        common = subsequence(item.masks, size, part)
        if common >= least * size and (best is None or common > best[0]):
            share = subsequence(item.answer_masks, len(item.answer), part) / len(item.answer)
            if share >= answer:
                best = common, share
    return best


def _parts(size: int) -> list[tuple[int, int]]:
    """Stretches of an item's words that are compared with passages: of ``SPAN`` words, and the whole where it is not much longer."""
    last = max(0, size - SPAN)
    runs = {(i, min(i + SPAN, size)) for i in [*range(0, last + 1, SPAN), last]}
    return sorted(runs | ({(0, size)} if size <= 2 * SPAN else set()))


def _rarest(items: list[Item], rarity: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted words, and for each from where to where its items are listed (edges, items).

    A stretch with ``least`` of an item's words misses at most the rest of them. So it has one of the words at any places that
    are one more than these; the rarest are taken.
    """
    pairs = set()
    for i, item in enumerate(items):
        ids = np.array(item.words, np.uint64)
        missing = len(ids) - int(np.ceil(least * len(ids) - 1e-9))
        order = np.lexsort((ids, -rarity[_feature(ids)]))
        pairs |= {(int(w), i) for w in ids[order[: missing + 1]]}
    listed = sorted(pairs)
    values, first = np.unique(np.array([w for w, _ in listed], np.uint64), return_index=True)
    return values, np.append(first, len(listed)), np.array([i for _, i in listed], np.int64)


def _places(ids: np.ndarray, rarest: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Sorted (item * words of the chunk + place) of all rare words of items."""
    values, edges, owners = rarest
    likely = np.zeros(FEATURES, bool)
    likely[_feature(values)] = True
    place = np.flatnonzero(likely[_feature(ids)])
    at = np.minimum(np.searchsorted(values, ids[place]), len(values) - 1)
    same = values[at] == ids[place]
    place, at = place[same], at[same]
    many = edges[at + 1] - edges[at]
    listed = np.repeat(edges[at] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    return np.sort(owners[listed] * len(ids) + np.repeat(place, many))


def _block_sums(latent: np.ndarray, feature: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the latent vectors of each block of words, word by word, so that a task holds a few vectors per block.

    ``latent`` ends with a row of zeros, which stands for words that a block does not have. Words are added in the order in which
    ``np.add.reduceat`` adds them, so sums are equal to the last bit.
    """
    lengths = np.diff(np.append(starts, len(feature)))

    def word(k: int, of: slice | np.ndarray = slice(None)) -> np.ndarray:
        return latent[np.where(lengths[of] > k, feature[np.minimum(starts[of] + k, len(feature) - 1)], len(latent) - 1)]

    total = word(1) + word(2)
    total += word(3) + word(4)
    more = word(5) + word(6)
    more += word(7) + word(8)
    total += more
    for k in range(9, int(lengths.max())):
        total += word(k)
    short = np.flatnonzero(lengths < 9)  # added one after another
    few = np.zeros((len(short), latent.shape[1]), latent.dtype)
    for k in range(1, 8):
        few += word(k, short)
    total[short] = few
    return word(0) + total


def _search(docs: DataFrame, items: list[Item], latent: np.ndarray, rarity: np.ndarray, cosine: float, least: float, answer: float) -> DataFrame:
    words_of = [_feature(np.array(i.words, np.uint64)) for i in items]
    pieces = [(i, low, high) for i, item in enumerate(items) for low, high in _parts(len(item.words))]
    owner = np.array([i for i, _, _ in pieces])
    sums = np.stack([latent[words_of[i][low:high]].sum(axis=0) for i, low, high in pieces])
    targets = (sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)).T.copy()
    sizes = np.array([len(item.words) for item in items])
    rarest = _rarest(items, rarity, least)
    padded = np.vstack([latent, np.zeros((1, latent.shape[1]), latent.dtype)])
    block = max(1, min(8192, (1 << 22) // len(pieces)))  # passages whose cosines a task holds at once
    kind = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("item_id", pa.int64()), ("lcs", pa.int64()), ("item_words", pa.int64()),
                      ("ratio", pa.float64()), ("answer_ratio", pa.float64()), ("cosine", pa.float64())])

    def candidates(ids: np.ndarray, starts: np.ndarray, passages: np.ndarray, first: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and passages that are near each other, with a rare word of the item in what is compared around the passage."""
        near = []
        for a in range(0, len(passages), block):
            places, which = np.divmod(np.flatnonzero(passages[a : a + block] @ targets >= cosine), targets.shape[1])
            near.append(np.unique(owner[which] * len(starts) + a + places))
        rare = _places(ids, rarest)
        item, place = np.divmod(rare, len(ids))
        short = sizes[item] < HALF  # whole passages say little about these items
        passage = np.searchsorted(starts, place[short], side="right") - 1
        before = np.maximum(passage - 1, 0)
        before = np.where(text[before] == text[passage], before, passage)
        pairs = np.unique(np.concatenate([*near, item[short] * len(starts) + passage, item[short] * len(starts) + before]))
        item, passage = np.divmod(pairs, len(starts))
        low = np.maximum(starts[passage] - sizes[item], first[text[passage]])
        high = np.minimum(starts[passage] + SPAN + sizes[item], first[text[passage] + 1])
        met = np.searchsorted(rare, item * len(ids) + high) > np.searchsorted(rare, item * len(ids) + low)
        return item[met], passage[met]

    def dense(feature: np.ndarray, low: np.ndarray, high: np.ndarray, i: int) -> np.ndarray:
        """Which stretches from ``low`` to ``high`` have enough of item i's words in what ``_checked`` compares at a time."""
        own[words_of[i]] = True
        size, width = int(sizes[i]), int((high - low).max())
        at = low[:, None] + np.arange(width)
        count = np.zeros((len(low), width + 1), np.int32)
        np.cumsum(own[feature[np.minimum(at, len(feature) - 1)]] & (at < high[:, None]), axis=1, out=count[:, 1:])
        own[words_of[i]] = False
        span = np.minimum(np.arange(width) + size + size // 2 + 1, width)
        return (count[:, span] - count[:, :-1]).max(axis=1) >= least * size

    own = np.zeros(FEATURES, bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, digests = batch.column(0), batch.column(1)
            for low, _, data, offsets in text_chunks(batch.column(2), 1 << 20):
                ids, first = word_ids(data, offsets)
                if not len(ids):
                    continue
                starts, text = _cuts(first, HALF)
                feature = _feature(ids)
                blocks = _block_sums(padded, feature, starts)
                passages = blocks.copy()
                joined = np.flatnonzero(text[1:] == text[:-1])
                passages[joined] += blocks[joined + 1]
                passages /= np.maximum(np.sqrt((passages * passages).sum(axis=1, keepdims=True)), 1e-12)
                found: dict[tuple[int, int], tuple] = {}
                item, passage = candidates(ids, starts, passages, first, text)
                row = text[passage]
                begin_at = np.maximum(starts[passage] - sizes[item], first[row])
                end_at = np.minimum(starts[passage] + SPAN + sizes[item], first[row + 1])
                edges = np.append(np.flatnonzero(np.diff(item, prepend=-1)), len(item)).tolist()  # candidates come item by item
                steps = [(a, min(a + _STRETCHES, y)) for x, y in zip(edges, edges[1:]) for a in range(x, y, _STRETCHES)]
                enough = [dense(feature, begin_at[a:b], end_at[a:b], int(item[a])) for a, b in steps]
                likely = np.flatnonzero(np.concatenate(enough)) if enough else np.zeros(0, np.int64)
                for i, p in zip(item[likely].tolist(), passage[likely].tolist()):
                    size, r = int(sizes[i]), int(text[p])
                    if (r, i) in found and found[r, i][0] == size:
                        continue
                    begin = int(starts[p] - first[r])
                    good = _checked(items[i], ids[first[r] : first[r + 1]], begin, begin + SPAN, least, answer)
                    if good and ((r, i) not in found or good[0] > found[r, i][0]):
                        found[r, i] = (*good, float((passages[p] @ targets[:, owner == i]).max()))
                rows = [
                    (names[low + r].as_py(), digests[low + r].as_py(), items[i].id, lcs, len(items[i].words), lcs / len(items[i].words), share, near)
                    for (r, i), (lcs, share, near) in found.items()
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    schema = "doc_id long, digest long, item_id long, lcs long, item_words long, ratio double, answer_ratio double, cosine double"
    return docs.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, *, cosine: float = 0.45, least: float = 0.65, answer: float = 0.5,
                 doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One row per document and benchmark item (item_id, text) found in it: doc_id, item_id, lcs, item_words, ratio,
    answer_ratio, cosine.

    Args:
        cosine: least latent cosine of a passage and a part of an item for a candidate. Items of less than ``HALF`` words need none.
        least: part of the item's words that the longest common subsequence must reach within one and a half times its length.
        answer: the same for its last sentence.
        digest: whether to add ``digest``, the xxhash64 of the document's text, which tells documents of one id apart.

    Words are compared without case (A-Z) and surrounding punctuation. Null or empty texts contain nothing and items without
    words are not looked for. A repeated row of ``docs`` gives repeated rows, a null id is kept. Items are searched in blocks of a
    few megabytes, each in one pass over the documents. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("digest"), F.col(f"`{text}`").alias("text"))
    latent, rarity = latent_words(rows.select("text"), benchmark)
    blocks, held, size = [], [], 0
    wanted = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text")
    for r in wanted.toLocalIterator():
        item = Item(r["item_id"], r["text"])
        if item.words:
            held.append(item)
            size += len(r["text"])
        if size > _ITEMS or len(held) >= _MOST:
            blocks.append(_search(rows, held, latent, rarity, cosine, least, answer))
            held, size = [], 0
    if held or not blocks:
        nothing = rows.select("doc_id").limit(0).selectExpr(
            "doc_id", "0L as digest", "0L as item_id", "0L as lcs", "0L as item_words", "0D as ratio", "0D as answer_ratio", "0D as cosine"
        )
        blocks.append(_search(rows, held, latent, rarity, cosine, least, answer) if held else nothing)
    out = blocks[0]
    for block in blocks[1:]:
        out = out.unionByName(block)
    return out if digest else out.drop("digest")
