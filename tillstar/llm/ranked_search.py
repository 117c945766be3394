"""Ranked lexical search by pipelined term partitioning.

Terms are owned by stages: the rarest by the first, the most frequent by the last. Documents are dealt into shards by hash.
For every shard, a bundle of items travels through the stages by cogroup: it carries the items' terms with their
weights, and per item a sparse list of documents with the scores gathered so far. An owner holds the postings of its
terms for the shard, adds their integer contributions and sends the bundle on. After the last stage each shard gives its
best documents of every item, from which the final ranking is selected.

A stage drops a document from an item's list only if what the item's later terms can still add leaves it below the
score that ``k`` documents of the shard have already, so it cannot be among the ``k`` best. This is exact, for documents
met in a later stage as well, and keeps the lists short: frequent terms come last and add least.

Texts are read once. A term's postings are kept only if it may occur in an item, which a Bloom filter of fixed size
(``FILTER_BITS``) tells; what it lets through wrongly no owner looks at. Owners are told apart by the document frequency
of the ``FREQUENT`` most frequent terms (a list of bounded size); all others belong to the first stage.

Results for special rows: a null text or one without terms is no document for N and L and is never found; an item without
terms or with terms that no document has gets no row. Every row of documents counts as a document of its own, also
if it shares its doc_id; equal scores are ordered by doc_id, nulls last. Rows of items that share an item_id count once, with
their smallest text.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import BoundedCache, small_batches, text_or_empty
from tillstar.session import stored

FILTER_BITS = 1 << 23  # of the Bloom filter, one megabyte
FREQUENT = 4096  # terms whose stage is listed; any others belong to the first one
SHARES = (512, 64, 8)  # a term of more than 1/share of the documents belongs to a later stage
SHARD = 8192  # documents of a shard, on average
BLOCK = 256  # items of a bundle, on average

LAST = len(SHARES)  # stage of the most frequent terms
_NULL = np.iinfo(np.int64).max  # stands for a null doc_id between stages: behind all others

#: ASCII that is neither digit nor letter separates terms; A-Z are lower-cased; all other bytes belong to terms.
_BYTES = bytes(
    c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256)
)

POSTINGS = "row bigint, doc_id bigint, n bigint, terms array<string>, times array<bigint>"
ITEM_TERMS = "item_id bigint, term string, repeats bigint"
BUNDLE = (
    "block bigint, shard bigint, item_id bigint, terms array<string>, gains array<bigint>, caps array<bigint>, owners array<bigint>, "
    "rows array<bigint>, doc_ids array<bigint>, scores array<bigint>"
)
_LISTS = ("gains", "caps", "owners", "rows", "doc_ids", "scores")
_BUNDLE = pa.schema(
    [(c, pa.int64()) for c in ("block", "shard", "item_id")] + [("terms", pa.list_(pa.string()))] + [(c, pa.list_(pa.int64())) for c in _LISTS]
)


def term_counts(text: bytes) -> Counter:
    """Terms of a UTF-8 text with their numbers."""
    return Counter(text.translate(_BYTES).split())


def _texts(column: pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, repeats) of every item."""

    def work(batches):
        for batch in batches:
            found = [(key, *pair) for key, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))) for pair in term_counts(text).items()]
            keys, terms, times = zip(*found) if found else ((), (), ())
            cells = [pa.array(keys, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, names=["item_id", "term", "repeats"])

    one = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").groupBy("item_id").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    return one.mapInArrow(work, ITEM_TERMS)


def _positions(hashed: Column) -> Column:
    """The two places of a term in the filter."""
    low, high = F.pmod(hashed, F.lit(FILTER_BITS)), F.pmod(F.shiftright(hashed, 32), F.lit(FILTER_BITS))
    return F.array(low, high)


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bits of the Bloom filter of ``terms``, 64 to a row: ``FILTER_BITS`` / 64 rows at most come to the driver."""
    places = terms.select(F.explode(_positions(F.xxhash64("term"))).alias("place"))
    bits = places.groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[bits.column("word").to_numpy()] = bits.column("bits").to_numpy()
    return words


def postings(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """For each row: number of its terms with repeats, and the terms that the filter lets through with their numbers."""
    small_batches(docs.sparkSession)

    def wanted(term: bytes) -> bool:
        hashed = xxhash.xxh64_intdigest(term, 42)  # as Spark's xxhash64
        signed = hashed - (1 << 64) if hashed >> 63 else hashed
        return all(words[place >> 6] >> (place & 63) & 1 for place in (signed % FILTER_BITS, (signed >> 32) % FILTER_BITS))

    def work(batches):
        known = BoundedCache(wanted)
        for batch in batches:
            sizes, ends, terms, times = [], [0], [], []
            for text in _texts(batch.column(2)):
                counts = term_counts(text)
                found = [term for term in counts if known[term]]
                sizes.append(counts.total())
                terms += found
                times += map(counts.__getitem__, found)
                ends.append(len(terms))
            cuts = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(cuts, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64())),
                ],
                names=["row", "doc_id", "n", "terms", "times"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(work, POSTINGS)


def weights(found: DataFrame, wanted: DataFrame, n_docs: int) -> DataFrame:
    """(term, df, w, cap, owner) of the wanted terms that documents have; cap bounds what one occurrence in an item adds."""
    listed = found.select(F.explode(F.arrays_zip("terms", "times")).alias("p")).select("p.terms", "p.times")
    counted = listed.groupBy(F.col("terms").alias("term")).agg(F.count(F.lit(1)).alias("df"), F.max("times").alias("most"))
    known = counted.join(wanted, "term", "left_semi")
    w = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    # no document has a smaller m than 75, and the contribution grows with tf
    cap = F.col("w") * F.expr("(1000000000 * most) div (1000 * most + 900)")
    return known.withColumn("w", w).select("term", "df", "w", cap.alias("cap"))


def frequent_terms(weighed: DataFrame, n_docs: int) -> dict[int, int]:
    """Stages of the most frequent terms by hash of the term: ``FREQUENT`` entries at most."""
    rows = weighed.where(F.col("df") * SHARES[0] > n_docs).orderBy(F.col("df").desc(), "term").limit(FREQUENT)
    found = rows.select(F.xxhash64("term").alias("h"), "df").toArrow()
    return {h: sum(df * s > n_docs for s in SHARES) for h, df in zip(found.column("h").to_pylist(), found.column("df").to_pylist())}


def owned(found: DataFrame, stages: dict[int, int], shards: int) -> DataFrame:
    """Postings by owner and shard, with the m of each document; a row for each owner that has terms of the document."""

    def stage_of(term: str) -> int:
        hashed = xxhash.xxh64_intdigest(term.encode(), 42)
        return stages.get(hashed - (1 << 64) if hashed >> 63 else hashed, 0)

    def work(batches):
        known = BoundedCache(stage_of)
        for batch in batches:
            coded = batch.column(4).flatten().dictionary_encode()
            owner = np.array([known[t] for t in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
            doc = np.repeat(np.arange(len(batch)), np.diff(batch.column(4).offsets.to_numpy()))
            times = batch.column(5).flatten()
            for stage in range(LAST + 1):
                picked = np.flatnonzero(owner == stage)
                if not len(picked):
                    continue
                rows, first = np.unique(doc[picked], return_index=True)
                cuts, place = pa.array(np.append(first, len(picked)), pa.int32()), pa.array(picked)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), stage), pa.int32()), *(batch.column(c).take(pa.array(rows)) for c in range(4)),
                        pa.ListArray.from_arrays(cuts, coded.take(place).cast(pa.string())), pa.ListArray.from_arrays(cuts, times.take(place)),
                    ],
                    names=["owner", "shard", "row", "doc_id", "m", "terms", "times"],
                )

    shard = F.pmod(F.xxhash64("row"), F.lit(shards))
    rows = found.where(F.size("terms") > 0).select(shard.alias("shard"), "row", "doc_id", "m", "terms", "times")
    return rows.mapInArrow(work, "owner int, shard bigint, row bigint, doc_id bigint, m bigint, terms array<string>, times array<bigint>")


class Owner:
    """The postings of one stage for one shard: documents and contributions of a term with weight 1."""

    def __init__(self, part: pa.Table):
        part = part.combine_chunks()
        self.rows, self.doc_ids, self.known = np.empty(0, np.int64), np.empty(0, np.int64), {}
        if not len(part):
            return
        # doc_id may be null; nulls go last among equal scores
        ids = part.column("doc_id").combine_chunks()
        self.rows = part.column("row").to_numpy()
        self.doc_ids, self.nulls = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        terms, times = part.column("terms").combine_chunks(), part.column("times").combine_chunks()
        coded = terms.flatten().dictionary_encode()
        codes, tf = coded.indices.to_numpy(), times.flatten().to_numpy()
        doc = np.repeat(np.arange(len(part)), np.diff(terms.offsets.to_numpy()))
        order = np.argsort(codes, kind="stable")
        self.doc, tf = doc[order], tf[order]
        m = part.column("m").to_numpy()[self.doc]
        self.gain = (10**9 * tf) // (1000 * tf + 12 * m)
        self.ends = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
        self.known = {t: c for c, t in enumerate(coded.dictionary.to_pylist())}

    def add(self, scores: np.ndarray, term: str, weight: int) -> None:
        code = self.known.get(term)
        if code is not None:
            low, high = self.ends[code], self.ends[code + 1]
            scores[self.doc[low:high]] += weight * self.gain[low:high]  # a document once: its tf is one number


def _merged(owner: Owner, item: dict, stage: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rows, doc_ids and scores of an item's list after a stage."""
    scores = np.zeros(len(owner.rows), np.int64)
    later = 0
    for term, gain, cap, place in zip(item["terms"], item["gains"], item["caps"], item["owners"]):
        if place == stage:
            owner.add(scores, term, gain)
        elif place > stage:
            later += cap
    met = np.flatnonzero(scores)
    rows = np.concatenate([owner.rows[met], np.array(item["rows"], np.int64)])
    ids = np.concatenate([np.where(owner.nulls[met], _NULL, owner.doc_ids[met]) if len(met) else np.empty(0, np.int64), np.array(item["doc_ids"], np.int64)])
    rows, first, place = np.unique(rows, return_index=True, return_inverse=True)
    total = np.zeros(len(rows), np.int64)
    np.add.at(total, place, np.concatenate([scores[met], np.array(item["scores"], np.int64)]))
    ids = ids[first]
    if len(rows) > k:
        least = np.partition(total, len(rows) - k)[len(rows) - k]
        if stage == LAST:
            keep = np.lexsort((ids, -total))[:k]
        else:
            keep = np.flatnonzero(total + later >= least)
        rows, ids, total = rows[keep], ids[keep], total[keep]
    return rows, ids, total


def pass_on(bundles: DataFrame, held: DataFrame, stage: int, k: int) -> DataFrame:
    """Bundles after the owners of one stage have added their terms."""

    def work(bundle: pa.Table, part: pa.Table) -> pa.Table:
        owner, out = Owner(part), []
        for item in bundle.to_pylist():
            rows, ids, scores = _merged(owner, item, stage, k)
            rest = [i for i, place in enumerate(item["owners"]) if place > stage]
            item |= {c: [item[c][i] for i in rest] for c in ("terms", "gains", "caps", "owners")}
            out.append(item | {"rows": rows, "doc_ids": ids, "scores": scores})
        return pa.Table.from_pylist(out, schema=_BUNDLE)

    blocks = bundles.agg(F.max("block")).scalar()
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(blocks, F.lit(0).cast("bigint"))))
    mine = held.where(F.col("owner") == stage).select(each.alias("block"), "shard", "row", "doc_id", "m", "terms", "times")
    keys = ("block", "shard")
    return bundles.groupBy(*keys).cogroup(mine.groupBy(*keys)).applyInArrow(work, BUNDLE)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of each item."""
    wanted = stored(item_terms(items), "item_terms")
    found = stored(postings(docs, term_filter(wanted.select("term").distinct())), "postings")
    n_docs, n_terms, n_rows = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    weighed = stored(weights(found, wanted.select("term").distinct(), n_docs), "weights")
    stages = frequent_terms(weighed, n_docs)
    shards = max(1, -(-n_rows // SHARD))
    # decimals: 25 * n * N may not fit into 64 bits
    m = F.expr(f"75 + (cast(25 * n as decimal(20,0)) * cast({n_docs} as decimal(18,0))) div cast({max(1, n_terms)} as decimal(20,0))")
    held = stored(owned(found.withColumn("m", m.cast("bigint")), stages, shards), "owned")

    empty = F.array().cast("array<bigint>")
    place = F.lit(0)
    if stages:
        listed = docs.sparkSession.createDataFrame(list(stages.items()), "h bigint, owner bigint")
        weighed = weighed.withColumn("h", F.xxhash64("term")).join(F.broadcast(listed), "h", "left")  # FREQUENT rows at most
        place = F.coalesce("owner", F.lit(0))
    terms = wanted.join(weighed.withColumn("place", place.cast("bigint")), "term").select(
        "item_id", F.struct("term", (F.col("w") * F.col("repeats")).alias("gain"), (F.col("cap") * F.col("repeats")).alias("cap"), "place").alias("t")
    )
    # an item's terms travel together: they are one row of its bundle
    bundled = terms.groupBy("item_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    numbered = bundled.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, -(-bundled.count() // BLOCK)))))
    bundles = numbered.select(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"), "item_id",
        F.col("t.term").alias("terms"), F.col("t.gain").alias("gains"), F.col("t.cap").alias("caps"), F.col("t.place").alias("owners"),
        empty.alias("rows"), empty.alias("doc_ids"), empty.alias("scores"),
    )
    for stage in range(LAST + 1):
        bundles = stored(pass_on(bundles, held, stage, k), "bundles")
    best = bundles.select("item_id", F.explode(F.arrays_zip("doc_ids", "scores")).alias("b")).select(
        "item_id", F.nullif(F.col("b.doc_ids"), F.lit(int(_NULL))).alias("doc_id"), F.col("b.scores").alias("score")
    )
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
