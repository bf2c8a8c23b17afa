"""N-gram Jaccard join by prefixes under several global orders.

Two sets with a Jaccard similarity of at least t share a token among the first
n - ceil(t n) + 1 of each, whatever order all tokens of the corpus are put in. So
candidates are the pairs that share such prefix tokens under every one of several
orders, as many as it takes; only those are verified by their whole sets. All orders put rare tokens
first, as a table of hashed counts tells, and differ in how they order equally rare
ones. Equal sets meet as one before that.

Pairs are formed under the first order, and those left are held against the other
orders. A pair belongs to the first token that its sets share: none before it is shared,
which says how many tokens differ at least. A row of a prefix carries the tokens just
before its own, and where sets share one of those the pair is left to an earlier token;
so it is formed about once, in however many tasks its sets meet.

A row of a prefix of a smaller set also carries the parity of its tokens in each of 256 ranges: two
sets differ by at least as many tokens as parities, so that pairs of sets that are
alike, but not alike enough, mostly go where they meet. Pairs are then held against
their sets' parities in about as many ranges as a set has tokens.

Sets that neighbour one another under their first tokens, or under the least of a range
of tokens, rare or not, and whose sketches agree are verified first, in a few rounds,
each with other neighbours and only where these are of different components; so are the
sets of a key with its first one, which is in one round the set of the commonest tokens,
in a group of near copies the one that differs least from all. Most of
what is linked is connected by then, and what a component holds already is not paired
again, so that a large group of near copies costs links in proportion to its members.
What the rounds miss is found by the prefixes.
"""

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    BLOCK_BYTES,
    freed_shuffles,
    record_batch,
    slices,
    small_batches,
    whole_text,
    word_blocks,
    written,
)
from tidemark.llm.components import component_roots
from tidemark.session import new_folder, remove_folder

SHINGLE_WORDS = 5
PERCENT = 80
ORDERS = 2
LEADING = 2
MINIMA = 4
ROUNDS = 2
SKETCH_BITS = 64
SKETCH_MOST = 14
COUNTERS_LOG2 = 20
BLOCK_ROWS = 1 << 10
LAGGED_ROWS = 64
PAIRS_HELD = 1 << 20
WORDS_KNOWN = 1 << 18
SETS_SEEN = 1 << 16
TEXT_BYTES = 1 << 20
PLACE_BITS = 30
PARITIES = ("p0", "p1", "p2", "p3")
# Sets of more tokens may differ by more tokens than such parities ever show.
PARITIES_MOST = 640
BEFORE = ("t0", "t1")
ODD_BITS_MOST = 1 << 16

_U = np.uint64
_FACTORS = [xxhash.xxh64_intdigest(bytes([i]), 7) | 1 for i in range(64)]

_SETS = pa.schema([("lo", pa.int64()), ("hi", pa.int64()), ("shingles", pa.list_(pa.int64()))])
# ``odd`` are the set's parities, in as many ranges as it takes.
_CLASSES = pa.schema(
    [("lo", pa.int64()), ("hi", pa.int64()), ("n", pa.int32()), ("odd", pa.binary()), ("shingles", pa.list_(pa.int64()))]
)
# ``sketch`` has a bit of the least token of each of 64 ranges of tokens, ``common`` how common the
# set's tokens are.
_LEADS = pa.schema([(c, pa.int64()) for c in ("key", "ref", "n", "sketch", "common")])
# ``off`` is by how much the root of a set's component is less than its own number, mostly 0;
# BEFORE are the keys just before, the last one first, 0 where none is told.
_PREFIXES = pa.schema([(c, pa.int64()) for c in ("key", "ref", "meta", "off", *PARITIES, *BEFORE)])
_FOUND = pa.schema([(c, pa.int64()) for c in ("a", "b", "key", "block", "ref", "meta", "root", *PARITIES, *BEFORE)])
_PAIRS = pa.schema([(c, pa.int64()) for c in ("a", "b")])
_PLACED = pa.schema([(c, pa.int64()) for c in ("a", "b", "lo_a", "lo_b")])
_FETCHED = pa.schema([("a", pa.int64()), ("b", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("of_a", "of_b"))])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{field.name} {kinds[field.type]}" for field in schema)


def _mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scramble of unsigned 64-bit numbers, another for each seed."""
    x = values + _U(_FACTORS[seed])
    for shift, factor in ((33, _FACTORS[8]), (29, _FACTORS[9])):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return x ^ (x >> _U(32))


_NO_WORD = xxhash.xxh3_64_intdigest(b"")


class _Shingles:
    """Distinct shingles of texts, as ascending 64-bit hashes; hashes of words are kept, so many."""

    def __init__(self, words: int, block: int = BLOCK_BYTES):
        self._words, self._block, self._known = words, block, {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known, digest = self._known, xxhash.xxh3_64_intdigest
        if len(known) > WORDS_KNOWN:
            known.clear()
        for word in set(words).difference(known):
            known[word] = digest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def of(self, text: bytes) -> np.ndarray:
        """A-Z count as a-z, blanks (U+0020, U+0009 to U+000D) end words; a text of fewer words is one
        shingle, one without words has none."""
        carried, parts = np.zeros(0, np.uint64), []
        for words in word_blocks(text.lower(), self._block):
            held = np.concatenate([carried, self._hashes(words)])
            n = len(held) - self._words + 1
            if n > 0:
                total = np.zeros(n, np.uint64)
                for i in range(self._words):
                    total += held[i : i + n] * _U(_FACTORS[10 + i])
                parts.append(np.unique(_mixed(total)))
            carried = held[max(0, len(held) - self._words + 1) :]
        if parts:
            return np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
        return self._few(carried)

    @staticmethod
    def _few(hashes: np.ndarray) -> np.ndarray:
        """The one shingle of a text of fewer words."""
        if not len(hashes):
            return hashes
        factors = np.array(_FACTORS[10 : 10 + len(hashes)], np.uint64)
        return _mixed((hashes * factors).sum(keepdims=True), 1 + len(hashes) % 7)

    def of_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The same for each of some texts (as binary), all at once unless one is long."""
        if (pc.max(pc.binary_length(texts)).as_py() or 0) > self._block:
            return [self.of(text) for text in texts.to_pylist()]
        found = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
        lengths = found.value_lengths().to_numpy()
        coded = found.flatten().dictionary_encode()
        digests = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()]
        code = coded.indices.to_numpy()
        hashes = np.array(digests, np.uint64)[code] if digests else np.zeros(0, np.uint64)
        # Blanks at either end of a text leave an empty word.
        words = np.array([d != _NO_WORD for d in digests], bool)[code] if digests else np.zeros(0, bool)
        ends = np.cumsum(lengths)
        if not words.all():
            ends = np.concatenate([[0], np.cumsum(words)])[ends]
            hashes = hashes[words]
        total = np.zeros(max(0, len(hashes) - self._words + 1), np.uint64)
        for i in range(self._words):
            total += hashes[i : i + len(total)] * _U(_FACTORS[10 + i])
        total = _mixed(total)
        sets, start = [], 0
        for end in ends.tolist():
            if end - start >= self._words:
                sets.append(np.unique(total[start : end - self._words + 1]))
            else:
                sets.append(self._few(hashes[start:end]))
            start = end
        return sets


def _address(shingles: np.ndarray) -> np.ndarray:
    """128 bits of a set, as two longs."""
    return np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8")


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(values)))


def _sets_of(batch: pa.RecordBatch, column: str) -> Iterator[np.ndarray]:
    lists = batch.column(column)
    values = lists.flatten().to_numpy().view(np.uint64)
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    for start, end in zip(ends[:-1], ends[1:], strict=True):
        yield values[start:end]


def members(
    docs: DataFrame, words: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Written table, a row per row: id, n distinct shingles, and the set's address lo and hi, null
    for the empty set."""
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _Shingles(words)
        for part in slices(batches, 1, TEXT_BYTES):
            sets = shingles.of_all(part.column(1))
            found = [_address(s).tolist() if len(s) else (None, None) for s in sets]
            schema = pa.schema([part.schema.field(0), ("n", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
            lo, hi = ([f[i] for f in found] for i in (0, 1))
            yield record_batch(schema, part.column(0), [len(s) for s in sets], lo, hi)

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).cast("binary").alias("text"))
    return written(rows.mapInArrow(run, f"id {kind}, n long, lo long, hi long"), "jaccard-members")


def _to_sets(words: int):
    """Sets of texts, each once in a task as far as it remembers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = _Shingles(words), set()
        for part in slices(batches, 0, TEXT_BYTES):
            found = {}
            for own in shingles.of_all(part.column(0)):
                address = tuple(_address(own).tolist())
                if len(own) and address not in seen:
                    found[address] = own
                    seen.add(address)
            if len(seen) > SETS_SEEN:
                seen.clear()
            if found:
                lo, hi = zip(*found, strict=True)
                yield record_batch(_SETS, list(lo), list(hi), _lists(list(found.values())))

    return run


def _once_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets sorted by address, each once."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lo, hi = (batch.column(c).to_numpy() for c in ("lo", "hi"))
        new = np.concatenate([[last != (lo[0], hi[0])], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        last = (lo[-1], hi[-1])
        kept = batch.filter(pa.array(new))
        n = kept.column("shingles").value_lengths()
        odd = [_parities(own, _odd_bits(len(own))).tobytes() for own in _sets_of(kept, "shingles")]
        yield record_batch(_CLASSES, kept.column("lo"), kept.column("hi"), n, odd, kept.column("shingles"))


class _Classes:
    """The distinct sets as a table, numbered (ref), in buckets of lo, half of their address, which
    joins on it needn't shuffle."""

    def __init__(self, docs: DataFrame, words: int, text_column: str):
        self._spark = docs.sparkSession
        self._name, self._path = f"jaccard_{uuid.uuid4().hex}", new_folder(self._spark, "jaccard-classes")
        tasks = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        texts = docs.select(whole_text(text_column).cast("binary").alias("text"))
        sets = texts.mapInArrow(_to_sets(words), _ddl(_SETS))
        once = sets.repartition(tasks, "lo").sortWithinPartitions("lo", "hi").mapInArrow(_once_each, _ddl(_CLASSES))
        numbered = once.withColumn("ref", F.monotonically_increasing_id())
        numbered.write.bucketBy(tasks, "lo").option("path", self._path).saveAsTable(self._name)

    def table(self) -> DataFrame:
        return self._spark.table(self._name)

    def remove(self) -> None:
        self._spark.sql(f"DROP TABLE {self._name}")
        remove_folder(self._spark, self._path)


def _rarity(classes: DataFrame, log2: int) -> np.ndarray:
    """A small number for each of 2^log2 counters of hashed tokens: 0 where the counter holds what
    chance gives any, more by one for each doubling. The driver gets the counters, as rows of 4096."""
    size, width = 1 << log2, min(1 << log2, 4096)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().view(np.uint64)
            total += np.bincount((values >> _U(64 - log2)).astype(np.int64), minlength=size)
        if total.any():
            schema = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("counts", pa.list_(pa.int64()))])
            blocks = list(total.reshape(-1, width))
            yield record_batch(schema, np.arange(len(blocks)), np.full(len(blocks), int(total.sum()) % 64), blocks)

    def add(table: pa.Table) -> pa.Table:
        total = sum(c.values.to_numpy().reshape(-1, width).sum(axis=0) for c in table["counts"].chunks)
        return pa.table({"block": table["block"].slice(0, 1), "counts": pa.array([total], pa.list_(pa.int64()))})

    counted = classes.select("shingles").mapInArrow(count, "block int, part int, counts array<long>")
    for by in (["block", "part"], ["block"]):
        counted = counted.groupBy(*by).applyInArrow(add, "block int, counts array<long>")
    counters = np.zeros(size)
    for row in counted.collect():
        counters[row["block"] * width : (row["block"] + 1) * width] = row["counts"]
    usual = counters.mean() + 6 * np.sqrt(counters.mean()) + 1
    return np.where(counters <= usual, 0, 1 + np.log2(np.maximum(counters, 1) / usual)).astype(np.uint8)


def _ranks(shingles: np.ndarray, order: int, rarity: np.ndarray, log2: int) -> np.ndarray:
    """Where the tokens stand in the given order: rarer first, then as the order's scramble has it."""
    rare = rarity[(shingles >> _U(64 - log2)).astype(np.int64)].astype(np.uint64)
    return rare << _U(58) | _mixed(shingles, order) >> _U(6)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _first_tokens(shingles: np.ndarray, order: int, length: int, rarity: np.ndarray, log2: int) -> np.ndarray:
    """Keys of the first tokens under the order, first first; a key belongs to one token and order."""
    ranks = _ranks(shingles, order, rarity, log2)
    if length < len(ranks):
        first = np.argpartition(ranks, length - 1)[:length]
        first = first[np.argsort(ranks[first])]
    else:
        first = np.argsort(ranks)
    return _mixed(shingles[first], 32 + order)


_RANGES = np.arange(SKETCH_BITS, dtype=np.uint64) << _U(58)


def _sketched(own: np.ndarray, minima: int) -> tuple[np.ndarray, np.ndarray]:
    """A sketch of an ascending set, and the least tokens from the starts of some ranges on, as keys.

    Two sets of similarity s share such a token with probability s, and a bit with
    (1 + s) / 2; the tokens are hashes, so the ranges hold any of them alike.
    """
    at = np.searchsorted(own, _RANGES)
    least = _mixed(own[np.minimum(at, len(own) - 1)], 40)
    sketch = np.packbits((least & _U(1)).astype(np.uint8)).view(np.int64)
    chosen = np.arange(minima) * (SKETCH_BITS // max(1, minima))
    return sketch, _mixed(least[chosen] + chosen.astype(np.uint64), 41)


def _to_leads(rarity, log2: int, orders: int, leading: int, minima: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, keys, owners, known = batch.column(0).to_numpy(), [], [], []
            ns = batch.column(1).value_lengths().to_numpy()
            for row, own in enumerate(_sets_of(batch, "shingles")):
                sketch, found = _sketched(own, minima)
                for order in range(orders):
                    found = np.append(found, _first_tokens(own, order, min(leading, len(own)), rarity.value, log2))
                keys.append(found)
                owners.append(np.full(len(found), row))
                rare = rarity.value[(own >> _U(64 - log2)).astype(np.int64)]
                known.append((sketch[0], int(rare.sum(dtype=np.int64)) * 1024 // len(own)))
            if keys:
                key, owner = (np.concatenate(c) for c in (keys, owners))
                sketch, common = np.array(known, np.int64).T
                yield record_batch(_LEADS, _signed(key), refs[owner], ns[owner].astype(np.int64), sketch[owner], common[owner])

    return run


def _similar_sizes(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _neighbours(percent: int):
    """Pairs of sets of different components with similar sketches, each set with the one before it
    under a key and with the first of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = first = None
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns])
            if not rows.shape[1]:
                continue
            if last is None:
                last = first = rows[:, :1]
            key = rows[0]
            starts = np.concatenate([first[0] != key[:1], key[1:] != key[:-1]])
            # The first row of each row's key; keys that began in the batch before have theirs from there.
            heads = np.concatenate([first, rows], axis=1)
            at = np.maximum.accumulate(np.where(starts, np.arange(1, len(key) + 1), 0))
            before = np.concatenate([last, rows[:, :-1]], axis=1)
            others = np.concatenate([before, heads[:, at]], axis=1)
            found = _alike(np.concatenate([rows, rows], axis=1), others, percent)
            last, first = rows[:, -1:], heads[:, at[-1:]]
            if found.shape[1]:
                yield record_batch(_PAIRS, found.min(axis=0), found.max(axis=0))

    return run


def _alike(one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Which of the rows (key, ref, n, sketch, root) may be linked, by their sketches: pairs of refs."""
    near = (one[0] == other[0]) & (one[4] != other[4]) & _similar_sizes(one[2], other[2], percent)
    near[near] = np.bitwise_count((one[3] ^ other[3])[near].view(np.uint64)) <= SKETCH_MOST
    return np.stack([one[1][near], other[1][near]])


def _parities(own: np.ndarray, bits: int = 64 * len(PARITIES)) -> np.ndarray:
    """Whether the set has an odd number of tokens in each of so many ranges of their hashes, a power of two."""
    odd = np.bincount((own & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _odd_bits(n: int) -> int:
    return min(ODD_BITS_MOST, max(64 * len(PARITIES), 1 << (n - 1).bit_length()))


def _odd_apart(one: bytes, other: bytes) -> int:
    """How many parities of two sets differ, those of more ranges folded to the other's."""
    a, b = (np.frombuffer(side, np.uint64) for side in (one, other))
    least = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(side.reshape(-1, least), axis=0) for side in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _keys_before(found: np.ndarray, n: int, percent: int) -> list[np.ndarray]:
    """For each key of a set's prefix the one before it, the one before that, and so on; only the
    first of them beyond the places where sets of one size may meet first."""
    told = [np.concatenate([np.zeros(i, np.uint64), found])[: len(found)] for i in range(1, len(BEFORE) + 1)]
    for further in told[1:]:
        further[(100 + percent) * (n - np.arange(len(found))) < 2 * percent * n] = 0
    return told


def _to_prefixes(rarity, log2: int, percent: int):
    """A row for each prefix token under the first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, roots = (batch.column(c).to_numpy() for c in ("ref", "root"))
            keys, metas, owners, parities, before = [], [], [], [], []
            for row, own in enumerate(_sets_of(batch, "shingles")):
                found = _first_tokens(own, 0, prefix_length(len(own), percent), rarity.value, log2)
                keys.append(found)
                metas.append(np.arange(len(found)) | len(own) << PLACE_BITS)
                owners.append(np.full(len(found), row))
                told = own if len(own) <= PARITIES_MOST else own[:0]
                parities.append(_parities(told))
                before.append(_keys_before(found, len(own), percent))
            if keys:
                key, meta, owner = map(np.concatenate, (keys, metas, owners))
                bits = np.stack(parities)[owner]
                last = [_signed(np.concatenate(c)) for c in zip(*before, strict=True)]
                yield record_batch(_PREFIXES, _signed(key), refs[owner], meta, (refs - roots)[owner], *bits.T, *last)

    return run


def _fits(one: list[np.ndarray], other: list[np.ndarray], percent: int) -> np.ndarray:
    """Which rows (ref, meta, root, parities, before) that share a key are of different components,
    of similar sizes, at places in their prefixes that allow the overlap it takes if this is
    the first token they share, of sets that share none of the tokens just before, and whose
    parities differ no more than such sets' may."""
    mask = (1 << PLACE_BITS) - 1
    (n, at), (m, place) = ((meta >> PLACE_BITS & mask, meta & mask) for meta in (one[1], other[1]))
    reach = np.minimum(n - at, m - place)
    fits = (one[2] != other[2]) & _similar_sizes(n, m, percent) & ((100 + percent) * reach >= percent * (n + m))
    if not fits.any():
        return fits
    fits[fits] = ~_met_before(*(_those(side[4], fits) for side in (one, other)))
    bits, others = (_those(side[3], fits) for side in (one, other))
    apart = np.bitwise_count((bits ^ others).view(np.uint64)).sum(axis=1, dtype=np.int64)
    untold = np.maximum(n, m) > PARITIES_MOST
    fits[fits] = _those(untold, fits) | ((100 + percent) * apart <= (100 - percent) * _those(n + m, fits))
    return fits


def _those(column: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen rows of a column that has as many, or one row for all."""
    return np.broadcast_to(column, (*chosen.shape, *column.shape[1:]))[chosen]


def _met_before(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which sets share one of the tokens told before the one where they meet."""
    met = np.zeros(len(one), bool)
    for i in range(len(BEFORE)):
        for j in range(len(BEFORE)):
            met |= (one[:, i] == other[:, j]) & (one[:, i] != 0)
    return met


def _pairs_of(one: list[np.ndarray], other: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs (a, b) of the rows of both sides that fit."""
    fits = _fits(one, other, percent)
    ref, partner = _those(one[0], fits), other[0][fits]
    return np.stack([np.minimum(ref, partner), np.maximum(ref, partner)])


def _crossing(one: list[np.ndarray], other: list[np.ndarray], percent: int, within: bool) -> Iterator[np.ndarray]:
    """Pairs of rows that share a key, each row of one side with those of the other."""
    for i in range(len(one[0])):
        rest = slice(i + 1 if within else 0, None)
        found = _pairs_of([c[i : i + 1] for c in one], [c[rest] for c in other], percent)
        if found.shape[1]:
            yield found


def _lagged(rows: list[np.ndarray], group: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Pairs within groups of rows that stand one after the other, all groups at once."""
    for lag in range(1, len(group)):
        first = np.flatnonzero(group[:-lag] == group[lag:])
        if not len(first):
            break
        found = _pairs_of([c[first] for c in rows], [c[first + lag] for c in rows], percent)
        if found.shape[1]:
            yield found


class _Pairs:
    """Pairs found so far, each once; handed on when there are many."""

    def __init__(self):
        self._held, self._count = [], 0

    def add(self, pairs: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        for found in pairs:
            self._held.append(found)
            self._count += found.shape[1]
            if self._count >= PAIRS_HELD:
                yield from self.out()

    def out(self) -> Iterator[np.ndarray]:
        if self._held:
            found = np.concatenate(self._held, axis=1)
            found = found[:, np.lexsort(found)]
            yield found[:, np.concatenate([[True], (found[:, 1:] != found[:, :-1]).any(axis=0)])]
        self._held, self._count = [], 0


def _matrix(rows: pa.RecordBatch | pa.Table, columns: tuple[str, ...]) -> np.ndarray:
    return np.stack([rows.column(c).to_numpy() for c in columns], axis=1)


def _within_keys(percent: int, block_rows: int):
    """Pairs within each key's rows, which come one after the other; of a key with several blocks of
    rows the rows go on, too, by block."""

    def pair_rows(found: np.ndarray) -> pa.RecordBatch:
        nothing = pa.nulls(found.shape[1], pa.int64())
        return record_batch(_FOUND, *found, *[nothing] * (len(_FOUND) - len(_PAIRS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, key_at_hand, held, block = _Pairs(), None, [], 0

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            if held:
                rows = [np.concatenate(c) for c in zip(*held, strict=True)]
                if len(rows[0]) > 1 and (rows[2] != rows[2][0]).any():
                    yield from map(pair_rows, pairs.add(_crossing(rows, rows, percent, True)))
                if block or not last:
                    count = len(rows[0])
                    nothing = pa.nulls(count, pa.int64())
                    told = [np.full(count, key_at_hand), np.full(count, block), *rows[:3], *rows[3].T, *rows[4].T]
                    yield record_batch(_FOUND, *[nothing] * len(_PAIRS), *told)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, ref, meta, off = (c.to_numpy() for c in batch.columns[:4])
            columns = [ref, meta, ref - off, _matrix(batch, PARITIES), _matrix(batch, BEFORE)]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            ends = np.append(starts[1:], len(key))
            sizes = ends - starts
            # Keys that began in the batch before or may go on in the next, and large ones.
            apart = sizes > LAGGED_ROWS
            apart[[0, -1]] = True
            roots = columns[2]
            mixed = (np.minimum.reduceat(roots, starts) != np.maximum.reduceat(roots, starts)) & ~apart
            if mixed.any():
                inner = np.repeat(mixed, sizes)
                group = np.repeat(np.arange(len(starts)), sizes)[inner]
                yield from map(pair_rows, pairs.add(_lagged([c[inner] for c in columns], group, percent)))
            for start, end in zip(starts[apart].tolist(), ends[apart].tolist(), strict=True):
                if key[start] != key_at_hand:
                    yield from close(True)
                    key_at_hand, held, block = int(key[start]), [], 0
                while start < end:
                    room = block_rows - sum(len(h[0]) for h in held)
                    if not room:
                        yield from close(False)
                        held, block, room = [], block + 1, block_rows
                    held.append([c[start : min(end, start + room)] for c in columns])
                    start += len(held[-1][0])
        yield from close(True)
        yield from map(pair_rows, pairs.out())

    return run


def _between_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = [table[c].to_numpy() for c in ("ref", "meta", "root")]
        rows += [_matrix(table, PARITIES), _matrix(table, BEFORE)]
        first = (table["block"].to_numpy() == table["i"].to_numpy()).nonzero()[0]
        second = (table["block"].to_numpy() != table["i"].to_numpy()).nonzero()[0]
        pairs = _Pairs()
        found = [*pairs.add(_crossing([c[first] for c in rows], [c[second] for c in rows], percent, False)), *pairs.out()]
        both = np.concatenate(found, axis=1) if found else np.zeros((len(_PAIRS), 0), np.int64)
        return pa.Table.from_batches([record_batch(_PAIRS, *both)])

    return run


def _candidates(prefixes: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Pairs (a, b) of different components that meet under the first order where their sets may be
    similar enough; each once."""
    grouped = prefixes.repartition("key").sortWithinPartitions("key")
    found = written(grouped.mapInArrow(_within_keys(percent, block_rows), _ddl(_FOUND)), "jaccard-found")
    pairs = found.filter("a IS NOT NULL").select("a", "b")
    large = found.filter("key IS NOT NULL").select("key", "block", "ref", "meta", "root", *PARITIES, *BEFORE)
    blocks = large.groupBy("key").agg(F.max("block").alias("last"), F.min("root").alias("r"), F.max("root").alias("s"))
    blocks = written(blocks.filter("r <> s").select("key", "last"), "jaccard-blocks")
    if not blocks.isEmpty():
        sides = large.join(blocks, "key").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        sides = sides.filter("other <> block").withColumns(
            {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
        )
        between = sides.groupBy("key", "i", "j").applyInArrow(_between_blocks(percent), _ddl(_PAIRS))
        pairs = pairs.unionByName(between)
    return pairs.distinct()


def _enough(shared, beyond, total, percent: int):
    """Whether two sets that share so many tokens of their prefixes may be similar enough.

    Tokens that two sets have in common are in both prefixes, or else beyond the prefix of
    the one whose prefix ends first: ``beyond`` is the larger number of those, and ``total``
    both sets' tokens.
    """
    return (100 + percent) * (shared + beyond) >= percent * total


def _agreeing(rarity, log2: int, orders: int, percent: int):
    """Of pairs with their sets, those that share enough prefix tokens under the further orders, too."""

    def agree(one: np.ndarray, other: np.ndarray) -> bool:
        lengths = [prefix_length(len(s), percent) for s in (one, other)]
        beyond, total = max(len(one) - lengths[0], len(other) - lengths[1]), len(one) + len(other)
        for order in range(1, orders):
            firsts = (
                _first_tokens(s, order, length, rarity.value, log2)
                for s, length in zip((one, other), lengths, strict=True)
            )
            shared = len(np.intersect1d(*firsts, assume_unique=True))
            if not shared or not _enough(shared, beyond, total, percent):
                return False
        return True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (_sets_of(batch, c) for c in ("of_a", "of_b"))
            yield batch.filter(pa.array([agree(one, other) for one, other in zip(*sides, strict=True)], pa.bool_()))

    return run


def _not_apart(percent: int):
    """Of pairs with their sets' sizes and parities, those whose parities differ no more than such sets' may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            sides = (batch.column(c).to_pylist() for c in ("odd_a", "odd_b"))
            apart = np.array([_odd_apart(one, other) for one, other in zip(*sides, strict=True)], np.int64)
            near = pa.array((100 + percent) * apart <= (100 - percent) * sum(total))
            yield batch.select(_PLACED.names).filter(near)

    return run


def _verified(pairs: DataFrame, classes: DataFrame, percent: int, before=None) -> DataFrame:
    """The pairs whose whole sets are similar enough, as links (u, v).

    Pairs first learn their sets' addresses, by which the table of sets is in buckets.
    ``before`` is a filter on pairs with their sets; with it, pairs are first held against
    their sets' parities.
    """
    told = ["lo"] if before is None else ["lo", "n", "odd"]
    for side in ("a", "b"):
        places = classes.select(F.col("ref").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in told])
        pairs = pairs.join(places, side)
    if before is not None:
        pairs = pairs.mapInArrow(_not_apart(percent), _ddl(_PLACED))
    pairs = written(pairs.select(*_PLACED.names), "jaccard-pairs")
    for side in ("a", "b"):
        sets = classes.select("ref", F.col("lo").alias(f"lo_{side}"), F.col("shingles").alias(f"of_{side}"))
        # Sets that share half an address are told apart; not as a key, which would shuffle the sets.
        pairs = pairs.join(sets, f"lo_{side}").filter(F.col("ref") - F.col(side) == 0).drop("ref", f"lo_{side}")
    if before is not None:
        pairs = pairs.select("a", "b", "of_a", "of_b").mapInArrow(before, _ddl(_FETCHED))
    common = F.size(F.array_intersect("of_a", "of_b"))
    whole = F.size("of_a") + F.size("of_b") - common
    return pairs.filter(100 * common >= percent * whole).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _with_roots(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Sets with the least set of their component: ref, root and the other columns."""
    joined = classes.join(roots.withColumnRenamed("u", "ref"), "ref", "left")
    return joined.withColumn("root", F.coalesce("root", "ref"))


def _chained(leads: DataFrame, roots: DataFrame | None, turn: int, percent: int) -> DataFrame:
    """Pairs of sets of different components that are next to each other under a key, or of which
    one is the key's first: at first by how common their tokens are, then by size, then in
    orders of chance; written.

    The sets of a token are dealt by range, so many may share one; then each task has a first.
    """
    labelled = leads.withColumn("root", F.col("ref")) if roots is None else _with_roots(leads, roots)
    at = {0: -F.col("common"), 1: F.col("n")}.get(turn, F.xxhash64("key", "ref", F.lit(turn)))
    chained = labelled.select("key", "ref", "n", "sketch", "root", at.alias("at"))
    chained = chained.repartitionByRange("key", "at", "ref").sortWithinPartitions("key", "at", "ref").drop("at")
    pairs = chained.mapInArrow(_neighbours(percent), _ddl(_PAIRS)).select("a", "b").distinct()
    return written(pairs, "jaccard-neighbours")


def similar_groups(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    orders: int = ORDERS,
    leading: int = LEADING,
    minima: int = MINIMA,
    rounds: int = ROUNDS,
    counters_log2: int = COUNTERS_LOG2,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, n_shingles, and component_id, the smallest id that links reach.

    Documents are linked where their sets of distinct word shingles have a Jaccard
    similarity of at least ``percent`` in a hundred. A text of fewer words is one
    shingle; a text without words, null or empty, has none and is linked with
    nothing, so its component_id is its own id. Rows that repeat a text are linked
    like any equal texts, whether or not they share an id; a component without any
    id has component_id null. An empty table gives no rows. Other columns are not
    read. Very long texts are hashed block by block; their sets are held whole.

    Tokens are 64-bit hashes of shingles. Nothing is capped: rows of a key are
    compared in blocks of ``block_rows``, and blocks of a key two by two in tasks of
    their own. The driver gets 2^counters_log2 counters, whatever the input.
    """
    with freed_shuffles(docs.sparkSession), small_batches(docs.sparkSession):
        return _similar_groups(
            docs, words, percent, orders, leading, minima, rounds, counters_log2, block_rows, id_column, text_column
        )


def _similar_groups(
    docs, words, percent, orders, leading, minima, rounds, counters_log2, block_rows, id_column, text_column
) -> DataFrame:
    spark = docs.sparkSession
    rows = members(docs, words, id_column, text_column)
    classes = _Classes(docs, words, text_column)
    sets = classes.table()
    rarity = spark.sparkContext.broadcast(_rarity(sets, counters_log2))

    leads = sets.select("ref", "shingles").mapInArrow(_to_leads(rarity, counters_log2, orders, leading, minima), _ddl(_LEADS))
    path, roots = new_folder(spark, "jaccard-leads"), None
    leads.write.parquet(path)
    leads = spark.read.schema(leads.schema).parquet(path)
    for turn in range(rounds):
        pairs = _chained(leads, roots, turn, percent)
        if roots is not None and pairs.isEmpty():
            break
        links = _verified(pairs, sets, percent)
        known = [] if roots is None else [roots.withColumnRenamed("root", "v")]
        roots = component_roots(reduce(DataFrame.unionByName, known, links))
    remove_folder(spark, path)

    rooted = _with_roots(sets, roots).select("ref", "root", "shingles")
    prefixes = rooted.mapInArrow(_to_prefixes(rarity, counters_log2, percent), _ddl(_PREFIXES))
    candidates = written(_candidates(prefixes, percent, block_rows), "jaccard-candidates")
    further = _verified(candidates, sets, percent, _agreeing(rarity, counters_log2, orders, percent))
    roots = component_roots(roots.withColumnRenamed("root", "v").unionByName(further))

    firsts = rows.filter("n > 0").groupBy("lo", "hi").agg(F.min("id").alias("first"))
    known = _with_roots(sets.select("ref", "lo", "hi"), roots).join(firsts, ["lo", "hi"])
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = written(known.select("lo", "hi", "root").join(least, "root").drop("root"), "jaccard-labels")
    classes.remove()
    alone = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return rows.join(labels, ["lo", "hi"], "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), alone.alias("component_id")
    )
