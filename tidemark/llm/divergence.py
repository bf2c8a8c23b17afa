"""Source divergence audit: how far the sources of a language stray from each other in their terms.

Term counts come from single-pass in-memory indexing: each task builds the
postings of a block of texts in memory, until the block is full, and spills them
as a run sorted by term, cut by hash into shards. Each shard merges its runs with a
heap into frequencies. Of two sources only the terms that either holds tell them
apart from sources without any counts, so their divergence is a closed form plus
corrections for the terms that they hold, streamed over the merged frequencies.
"""

from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace
from itertools import chain, groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, record_batch, slices, whole_text, word_blocks, written

LEAST_DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50

# A block is full at so many bytes of text; a longer text is a block of its own.
BLOCK_TEXT = 16 << 20
CHUNK = 1 << 12
PAIRS_HELD = 1 << 20
SALTS = 16

# What is no letter of ASCII nor beyond it ends a term; only A-Z are lower-cased. As bytes of
# UTF-8, so that what is beyond ASCII stays as it is.
_FOLD = bytes(c if c >= 0x80 or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 0x20 for c in range(256))
_FOLDED = np.frombuffer(_FOLD, np.uint8)

# A chunk of a run: keys of terms, in how many documents each is, and their postings one after the
# other: where a term's end, and the source, as a place in names, and the occurrences of each.
_RUNS = pa.schema(
    [
        ("shard", pa.int32()),
        ("first", pa.binary()),
        ("keys", pa.list_(pa.binary())),
        ("docs", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int32())),
        ("names", pa.list_(pa.binary())),
        ("sources", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
    ]
)
_RUNS_DDL = """shard int, first binary, keys array<binary>, docs array<long>, ends array<int>,
    names array<binary>, sources array<int>, counts array<long>"""
_SOURCE = pa.struct([("source", pa.binary()), ("count", pa.int64())])
_FREQUENCIES = pa.schema(
    [("lang", pa.binary()), ("term", pa.binary()), ("count", pa.int64()), ("sources", pa.list_(_SOURCE))]
)
_CORRECTIONS = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

_END = b"\0\0"


def _key(lang: bytes, term: bytes) -> bytes:
    """Language and term as one key that orders like them; a zero byte within a language is no end
    of it, and terms hold none."""
    return lang.replace(b"\0", b"\0\1") + _END + term


def _parts(key: bytes) -> tuple[bytes, bytes]:
    lang, _, term = key.partition(_END)
    return lang.replace(b"\0\1", b"\0"), term


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The terms of texts (as binary): text and code of each occurrence, and the terms by code."""
    n, offsets = len(texts), np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = pa.py_buffer((offsets - offsets[0]).astype(np.int32))
    folded = pa.Array.from_buffers(pa.string(), n, [None, starts, pa.py_buffer(_FOLDED[data])])
    found = pc.ascii_split_whitespace(folded)
    text = np.repeat(np.arange(n), found.value_lengths().to_numpy())
    coded = found.flatten().dictionary_encode()
    code, terms = coded.indices.to_numpy(), coded.dictionary
    kept = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)
    if not kept.all():  # blanks at either end of a text leave an empty one
        own = kept[code]
        text, code = text[own], (np.cumsum(kept) - 1)[code[own]]
        terms = terms.filter(pa.array(kept))
    return text, code, terms.cast(pa.binary())


def _counted(*keys: np.ndarray) -> list[np.ndarray]:
    """Distinct rows of a first column, small, and a second; how often each occurs."""
    width = int(keys[1].max(initial=0)) + 1
    found, counts = np.unique(keys[0].astype(np.int64) * width + keys[1], return_counts=True)
    return [*np.divmod(found, width), counts]


class _Block:
    """Texts of a block with their languages and sources, and the postings of their terms."""

    def __init__(self):
        self._langs, self._sources, self._texts, self.bytes = [], [], [], 0

    def add(self, langs: list[bytes], sources: list[bytes], texts: pa.Array) -> None:
        self._langs += langs
        self._sources += sources
        self._texts.append(texts)
        self.bytes += pc.sum(pc.binary_length(texts)).as_py() or 0

    def spill(self, shards: int, chunk: int) -> Iterator[pa.RecordBatch]:
        """The run of the block; empties it."""
        if not self._langs:
            return
        groups = sorted(set(zip(self._langs, self._sources, strict=True)))
        langs, sources = (sorted({g[i] for g in groups}) for i in (0, 1))
        at = {g: i for i, g in enumerate(groups)}
        group = np.array([at[g] for g in zip(self._langs, self._sources, strict=True)], np.int64)
        lang_of = np.array([langs.index(g[0]) for g in groups], np.int64)
        source_of = np.array([sources.index(g[1]) for g in groups], np.int64)
        if len(self._texts) == 1 and len(self._langs) == 1:
            text, code, terms, times = self._one_text()
        else:
            text, code, terms = _terms(pa.concat_arrays(self._texts))
            times = None
        self.__init__()
        if not len(terms):
            return
        if times is None:
            in_group, term, count = _counted(group[text], code)
            in_text, held, _ = _counted(text, code)
            lang, of, docs = _counted(lang_of[group[in_text]], held)
        else:
            in_group, term, count = group[text], code, times
            lang, of, docs = lang_of[in_group], code, np.ones(len(code), np.int64)
        yield from _run(langs, sources, terms, (lang_of[in_group], term, source_of[in_group], count), (lang, of, docs), shards, chunk)

    def _one_text(self) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """The terms of a text that may be very long, block by block, each once with its number."""
        counts: Counter = Counter()
        for words in word_blocks(self._texts[0][0].as_py().translate(_FOLD)):
            counts.update(words)
        n = len(counts)
        return np.zeros(n, np.int64), np.arange(n), pa.array(list(counts), pa.binary()), np.array(list(counts.values()), np.int64)


def _run(langs, sources, terms: pa.Array, postings, documents, shards: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """A run, sorted by language, shard and term, in chunks of one of each: postings (language, term,
    source, occurrences), each once, and documents of each (language, term)."""
    lang, code, source, count = postings
    width = len(terms)
    rank = np.empty(width, np.int64)
    rank[pc.array_sort_indices(terms).to_numpy()] = np.arange(width)
    shard = np.array([crc32(t) % shards for t in terms.to_pylist()], np.int64)
    order = np.lexsort((source, rank[code], shard[code], lang))
    lang, code, source, count = lang[order], code[order], source[order], count[order]
    # One entry for each language and term, from start to end among the postings.
    starts = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (code[1:] != code[:-1])]))
    ends = np.append(starts[1:], len(code))
    of_lang, of_code = lang[starts], code[starts]
    known = documents[0] * width + documents[1]
    by_key = np.argsort(known)
    docs = documents[2][by_key][np.searchsorted(known[by_key], of_lang * width + of_code)]
    # A chunk ends with its language or shard, or when it is full.
    place = of_lang * shards + shard[of_code]
    segment = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    lengths = np.diff(np.append(segment, len(place)))
    cuts = np.concatenate([np.arange(s, s + n, chunk) for s, n in zip(segment, lengths, strict=True)])
    bounds = np.append(cuts, len(place)).astype(np.int32)
    prefixes = pa.array([_key(name, b"") for name in langs], pa.binary())
    keys = pc.binary_join_element_wise(prefixes.take(pa.array(of_lang)), terms.take(pa.array(of_code)), pa.scalar(b"", pa.binary()))
    first_posting = starts[cuts]
    within = (ends - np.repeat(first_posting, np.diff(bounds))).astype(np.int32)
    posting_bounds = np.append(first_posting, len(code)).astype(np.int32)

    def lists(values, at: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(at), values if isinstance(values, pa.Array) else pa.array(values))

    yield record_batch(
        _RUNS,
        shard[of_code[cuts]].astype(np.int32),
        keys.take(pa.array(cuts)),
        lists(keys, bounds),
        lists(docs, bounds),
        lists(within, bounds),
        [sources] * len(cuts),
        lists(source.astype(np.int32), posting_bounds),
        lists(count, posting_bounds),
    )


def _to_runs(shards: int, block_text: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for part in slices(batches, 2, min(block_text, SLICE_BYTES)):
            if part.num_rows == 1 and pc.binary_length(part.column(2))[0].as_py() >= block_text:
                yield from block.spill(shards, chunk)
            block.add(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2))
            if block.bytes >= block_text:
                yield from block.spill(shards, chunk)
        yield from block.spill(shards, chunk)

    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Chunks as (shard, (first key, keys, documents, ends, names, sources, occurrences))."""
    for batch in batches:
        shards, firsts, names = (batch.column(c).to_pylist() for c in ("shard", "first", "names"))
        for row in range(batch.num_rows):
            keys, docs, ends, sources, counts = (
                batch.column(c)[row].values for c in ("keys", "docs", "ends", "sources", "counts")
            )
            flat = (ends.to_numpy(), names[row], sources.to_numpy(), counts.to_numpy())
            yield shards[row], (firsts[row], keys.to_pylist(), docs.to_numpy().tolist(), *flat)


def _merge(chunks: Iterator[tuple], least: int) -> Iterator[tuple[bytes, list[tuple]]]:
    """The terms of a shard that are in so many documents, in the order of their keys: key, and each
    chunk that has it with its place there. The chunks come in the order of their first keys.

    A heap holds the chunks that have begun; one whose first key comes later isn't opened yet.
    """
    heap: list[tuple] = []
    at_hand, entries, total = None, [], 0
    for serial, chunk in enumerate(chain(chunks, [None])):
        first = chunk and chunk[0]
        while heap and (first is None or heap[0][0] < first):
            key, other, at, opened = heap[0]
            keys = opened[1]
            if at + 1 < len(keys):
                heapreplace(heap, (keys[at + 1], other, at + 1, opened))
            else:
                heappop(heap)
            if key == at_hand:
                total += opened[2][at]
                entries.append((at, opened))
            else:
                if total >= least:
                    yield at_hand, entries
                at_hand, entries, total = key, [(at, opened)], opened[2][at]
        if chunk:
            heappush(heap, (first, serial, 0, chunk))
    if total >= least and entries:
        yield at_hand, entries


def _to_frequencies(least: int):
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, own in groupby(_chunks(batches), key=itemgetter(0)):
            for key, entries in _merge((chunk for _, chunk in own), least):
                found: Counter = Counter()
                for at, (_, _, _, ends, names, sources, counts) in entries:
                    postings = slice(ends[at - 1] if at else 0, ends[at])
                    for source, n in zip(sources[postings].tolist(), counts[postings].tolist(), strict=True):
                        found[names[source]] += n
                sources = [{"source": source, "count": n} for source, n in found.items()]
                yield *_parts(key), found.total(), sources

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in terms(batches):
            held.append(row)
            if len(held) == CHUNK:
                yield record_batch(_FREQUENCIES, *map(list, zip(*held, strict=True)))
                held = []
        if held:
            yield record_batch(_FREQUENCIES, *map(list, zip(*held, strict=True)))

    return run


def term_frequencies(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    block_text: int = BLOCK_TEXT,
    chunk: int = CHUNK,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """Written table, a row per language and term in at least so many of its documents: lang, term,
    count, and sources, an array of (source, count)."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [whole_text(c).cast("binary").alias(c) for c in (lang_column, source_column, text_column)]
    runs = docs.select(*columns).mapInArrow(
        _to_runs(shards, block_text, chunk), _RUNS_DDL
    )
    sorted_runs = runs.repartition("shard").sortWithinPartitions("shard", "first")
    merged = sorted_runs.mapInArrow(
        _to_frequencies(least_documents),
        "lang binary, term binary, count long, sources array<struct<source: binary, count: long>>",
    )
    sources = F.transform("sources", lambda s: F.struct(s["source"].cast("string").alias("source"), s["count"].alias("count")))
    return written(
        merged.select(
            F.col("lang").cast("string").alias("lang"),
            F.col("term").cast("string").alias("term"),
            "count",
            sources.alias("sources"),
        ),
        "term-frequencies",
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * terms)), exact however large."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    below = (total + SMOOTHING * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", above, below))


def _pair_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For terms (lang, sources, their shares, their bases): of each two sources that both hold a
    term, what their difference there is beyond that of the terms' one-sided corrections; summed
    before they go out."""
    names: dict[tuple[str, str], int] = {}
    held, count = [], 0

    def out() -> pa.RecordBatch:
        known = list(names)
        a, b, values = np.concatenate(held, axis=1)
        pairs, place = np.unique(a * len(known) + b, return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, place, values)
        sides = [[known[i] for i in side] for side in np.divmod(pairs, len(known))]
        return record_batch(
            _CORRECTIONS, [x[0] for x in sides[0]], [x[1] for x in sides[0]], [x[1] for x in sides[1]], sums
        )

    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        p_all, base_all = (batch.column(i).flatten().to_numpy() for i in (2, 3))
        ends = np.cumsum(batch.column(1).value_lengths().to_numpy())
        for lang, own, end in zip(langs, sources, ends, strict=True):
            k = len(own)
            codes = np.array([names.setdefault((lang, source), len(names)) for source in own])
            p, base = p_all[end - k : end], base_all[end - k : end]
            # So many of the term's sources at a time that their pairs stay few.
            step = max(1, PAIRS_HELD // k)
            for start in range(0, k - 1, step):
                i, j = np.triu_indices(min(step, k - start), 1, k - start)
                i, j = i + start, j + start
                both = np.abs(p[i] - p[j]) - np.abs(p[i] - base[j]) - np.abs(base[i] - p[j]) + np.abs(base[i] - base[j])
                held.append(np.stack([codes[i], codes[j], both]))
                count += len(i)
                if count >= PAIRS_HELD:
                    yield out()
                    held, count = [], 0
            if not count:
                names = {}
    if count:
        yield out()


def divergence(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    block_text: int = BLOCK_TEXT,
    chunk: int = CHUNK,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for each source of each language.

    Part ``pair``: every other source of the language with the sum over its terms of
    the difference of the two sources' shares. Part ``term``: the terms by which the
    source exceeds the language most, ``top_terms`` at most. Ranks fall by value, then
    rise by the item's UTF-8. A term counts where at least ``least_documents``
    documents of the language hold it; shares are smoothed and in whole units, so all
    is exact.

    Null language, source or text is empty, which is a language or source like any
    other. A source without kept terms has pairs, too; without any kept term of the
    language their value is 0. Repeated rows count each. An empty table gives no rows.
    Other columns are not read, ids neither. A text takes memory in proportion to its
    length; the terms of a block are bounded. Sources are few beside documents: every
    two of a language are a row of the result.
    """
    arguments = (least_documents, block_text, chunk, lang_column, source_column, text_column)
    terms = term_frequencies(docs, *arguments)
    groups = docs.select(whole_text(lang_column).alias("lang"), whole_text(source_column).alias("source")).distinct()
    counts = terms.select("lang", "term", F.col("count").alias("in_lang"), F.inline("sources"))
    languages = terms.groupBy("lang").agg(F.sum("count").alias("lang_total"), F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("held"))
    known = groups.join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    known = known.select(
        "lang", "source", "lang_total", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "held", "v")]
    )
    known = known.withColumn("base", _share(F.lit(0).cast("long"), F.col("total"), F.col("v")))
    known = written(known, "source-totals")

    # A source may hold most terms, so its rows are spread over salts.
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    salted = known.filter("held > 0").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    shares = counts.withColumn("salt", salt).join(salted, ["lang", "source", "salt"])
    shares = written(
        shares.select(
            "lang", "source", "term", "count", "base",
            _share(F.col("count"), F.col("total"), F.col("v")).alias("p"),
            _share(F.col("in_lang"), F.col("lang_total"), F.col("v")).alias("q"),
        ),
        "term-shares",
    )

    # Where only one of two sources holds a term, the other's share is its base, so how often the
    # one has which share is all that matters.
    shape = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    others = known.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base"))
    own = known.select("lang", "source", "base")
    one_sided = (
        shape.join(own, ["lang", "source"])
        .join(others, "lang")
        .filter("source <> other")
        .select(
            "lang",
            F.least("source", "other").alias("a"),
            F.greatest("source", "other").alias("b"),
            (F.col("n") * (F.abs(F.col("p") - F.col("other_base")) - F.abs(F.col("base") - F.col("other_base")))).alias("value"),
        )
    )
    own_shares = F.array_sort(F.collect_list(F.struct("source", "p", "base"))).alias("s")
    by_term = shares.groupBy("lang", "term").agg(own_shares).select("lang", "s.source", "s.p", "s.base")
    both = by_term.mapInArrow(_pair_corrections, "lang string, a string, b string, value long")
    corrected = one_sided.unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("correction"))

    pairs = known.select("lang", "source", "v", "base").join(others, "lang").filter("source <> other")
    pairs = pairs.withColumns({"a": F.least("source", "other"), "b": F.greatest("source", "other")})
    pairs = pairs.join(corrected, ["lang", "a", "b"], "left").select(
        "lang",
        "source",
        F.lit("pair").alias("part"),
        F.col("other").alias("item"),
        F.coalesce(F.col("v") * F.abs(F.col("base") - F.col("other_base")), F.lit(0).cast("long")).alias("closed"),
        F.coalesce("correction", F.lit(0).cast("long")).alias("correction"),
    )
    pairs = pairs.select("lang", "source", "part", "item", (F.col("closed") + F.col("correction")).alias("value"))
    exceeding = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = exceeding.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
