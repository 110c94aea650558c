"""Exact n-gram Jaccard join by rare-first prefix filtering.

Two documents link when ``100 * intersection >= percent * union`` for their sets of word n-grams.

1. All documents' n-grams are counted in a table of counters, which orders n-grams rare first.  The table
   grows with the bytes of text up to ``MOST_COUNTERS``.  The order only has to be the same everywhere, so
   sharing counters costs no links; an n-gram in a given share of all documents stands out in the
   same way at any size.
2. Equal sets are one class, by their size and a digest of 64 bits; its least doc_id stands for it.
3. Linked sets share ``l`` n-grams of their prefixes (the ``n - ceil(t n) + l`` rarest).  Most n-grams of
   prefixes are in one set only; they are left out by sorting n-grams in blocks of a bounded size.
   N-grams that the counters show to be frequent skip the blocks, so no block gathers a hot one.
   Of what is left each set's first ``l - 1`` aren't joined on: the l-th n-gram that two linked sets share
   comes after them in both.  ``l`` is ``DEEP`` between sets of at least ``LARGE`` n-grams and 1 where one is
   smaller; sets that may link with either kind take part in both joins.
4. Documents that share an n-gram are compared with the bucket's first (the smallest set); pairs must pass
   the length filter, the positional filter and a suffix filter (an upper bound of the overlap from the
   counts of n-grams by hash range), and are verified once, on the whole texts.
5. Verified links are joined into components.  Buckets that still hold more than one component go on: some of
   their members, chosen by a hash (about 32 a bucket), are compared with those of other components;
   after this turn the members of different components are joined in full under the same
   filters.  Pairs inside a component need no comparing, so a group of near copies costs its size
   and not its square, even one in which only a tenth of the pairs link; and no link between components is lost.

Memory: documents are handled in slices; texts are shuffled only for documents in candidate pairs (a bit
table, which grows with these up to ``MOST_BITS``, lets most others go before the shuffle, a join lets go the rest).
Both tables are at most 16 MB, however large the input.  What a turn links is contracted to one link a document
before the next turn's links are added.
Skew: buckets are reduced with salts; joins by document are left to adaptive splitting.

Defined results: null texts and texts without words have the empty set and link with nothing; fewer words
than n form one n-gram; rows that share a doc_id are one node (and one result row each);
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import dropped, stored
from .components import components
from .skew import with_group
from .textbatch import mix, release, shingle_sets, slices

#: Bytes of text for each counter of the frequency table, its least and greatest size, and the rows it is dealt into for summing.
COUNTER_BYTES, LEAST_COUNTERS, MOST_COUNTERS, PARTS = 2048, 1 << 19, 1 << 22, 32
#: N-grams of prefixes in a block, on average; n-grams with so many times the mean count skip the blocks.
BLOCK_ROWS, HOT = 1_000_000, 8
#: N-grams that prefixes of large sets must share, and from which size a set is large.
DEEP, LARGE = 8, 64
#: Bits of the table of documents in candidate pairs: for each of these, at least, and at most.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 27
#: Hash ranges of the suffix filter.
RANGES = 256
#: After the turn in which buckets are compared with their smallest set: with how many members in each further turn, before all that is left is joined.
SOME = (32,)
#: N-grams of a set by which a pair that is met several times is told.
FIRST = 32

PROFILE = "doc_id long, n long, class long, main boolean, deep int, prefix array<long>, ranges array<tinyint>"
POSTING = "h long, class long, n long, deep int, pos int"


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))


def _power_of_two(n: int, least: int, most: int) -> int:
    """The least power of two from ``n`` on within bounds that are powers of two."""
    return min(most, max(least, 1 << max(0, n - 1).bit_length()))


def frequencies(texts: DataFrame, width: int) -> np.ndarray:
    """Documents by counter, over all documents. The result has a bounded size."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counters = _power_of_two(total // COUNTER_BYTES, LEAST_COUNTERS, MOST_COUNTERS)
    size = counters // PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), width)
                if sets:
                    total += np.bincount((np.concatenate(sets) & np.uint64(counters - 1)).astype(np.int64), minlength=counters)
        if total.any():
            parts = total.reshape(PARTS, size)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])
        release()

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, np.int64)
        for counts in frame["counts"]:
            total += np.frombuffer(counts, np.int64)
        return pd.DataFrame({"part": [key[0]], "counts": [total.tobytes()]})

    schema = "part int, counts binary"
    # summed in two steps, so that no task gathers the tables of all tasks
    counted = texts.select("text").mapInArrow(count, schema).withColumn("bunch", F.spark_partition_id() % 64)
    sums = counted.groupBy("part", "bunch").applyInPandas(add, schema).groupBy("part").applyInPandas(add, schema).collect()
    out = np.zeros((PARTS, size), np.int64)
    for row in sums:
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(out.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def profiles(texts: DataFrame, width: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(doc_id, n, class, deep, prefix, ranges): what the filters need of each document; class is a digest of its set.

    A document that takes part in both joins has a second row, with deep = 1, which isn't its main one.
    Ranges are null where one has more than 127 n-grams; the suffix filter then lets pairs pass.
    """
    shared = texts.sparkSession.sparkContext.broadcast(counts)
    mask = np.uint64(len(counts) - 1)
    shift = np.uint64(64 - (RANGES - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[list] = [[], [], [], [], [], [], []]
                for key, own in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"), width), strict=True):
                    size = len(own)
                    digest = int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)
                    order = np.lexsort((own, counts[(own & mask).astype(np.int64)]))
                    spare = size - -(-percent * size // 100)
                    ranges = np.bincount((own >> shift).astype(np.int64), minlength=RANGES)
                    ranges = ranges.astype(np.int8) if ranges.max() < 128 else None
                    joins = [(True, DEEP if size >= LARGE else 1, ranges)]
                    if size >= LARGE and percent * size < 100 * LARGE:
                        joins.append((False, 1, None))
                    for main, deep, of in joins:
                        for column, value in zip(rows, (key, size, digest, main, deep, own[order[: spare + deep if size else 0]].view(np.int64), of), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int8())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["doc_id", "n", "class", "main", "deep", "prefix", "ranges"])
        release()

    found = stored(texts.mapInArrow(run, PROFILE), "profiles")
    shared.destroy()
    return found


def shared_postings(own: DataFrame, counts: np.ndarray) -> DataFrame:
    """(h, class, n, deep, pos): the n-grams of prefixes that more than one class has, once for each class and join.

    N-grams go to blocks by their hash; a block's rows are cut where n-grams change and single ones go.
    Copies in one batch are put in once.
    """
    total = own.agg(F.sum(F.size("prefix"))).first()[0] or 0
    blocks = max(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK_ROWS))
    hot = counts > HOT * max(1.0, float(counts.mean())) + 1000
    shared, mask = own.sparkSession.sparkContext.broadcast(np.packbits(hot)), np.uint64(len(counts) - 1)
    packed = "block int, h binary, class binary, n binary, deep binary, pos binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            _, first = np.unique(batch.column("class").to_numpy() * 2 + (batch.column("deep").to_numpy() > 1), return_index=True)
            batch = batch.take(pa.array(np.sort(first)))
            lists = batch.column("prefix")
            size = np.diff(lists.offsets.to_numpy())
            h = lists.flatten().to_numpy().view(np.uint64)
            begin = np.cumsum(size) - size
            deep = np.repeat(batch.column("deep").to_numpy(), size)
            plain_h, h = h, np.where(deep > 1, h, mix(h))  # the two joins don't meet
            columns = [plain_h, np.repeat(batch.column("class").to_numpy(), size), np.repeat(batch.column("n").to_numpy(), size), deep, (np.arange(len(h)) - np.repeat(begin, size)).astype(np.int32)]
            # frequent n-grams keep single rows under the block -1
            block = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
            block[frequent[(columns[0] & mask).astype(np.int64)]] = -1
            columns[0] = h
            order = np.argsort(block, kind="stable")
            block = block[order]
            cuts = np.flatnonzero(np.diff(block, prepend=-2))
            ends = np.append(cuts[1:], len(block))
            parts = [[c[order[x:y]].tobytes() for x, y in zip(cuts, ends, strict=True)] for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(block[cuts].astype(np.int32)), *[pa.array(x, pa.binary()) for x in parts]], names=["block", "h", "class", "n", "deep", "pos"])

    def unpack(frame: pd.DataFrame) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(frame[c]), kind) for c, kind in (("h", np.int64), ("class", np.int64), ("n", np.int64), ("deep", np.int32), ("pos", np.int32))]

    def repeated(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        columns = unpack(frame)
        order = np.lexsort((columns[2], columns[1], columns[0]))
        h, classes, n = (c[order] for c in columns[:3])
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (classes[1:] != classes[:-1]) | (n[1:] != n[:-1])
        order, h = order[fresh], h[fresh]
        same = h[1:] == h[:-1]
        order = order[np.append(same, False) | np.append(False, same)] if len(h) else order
        return pd.DataFrame({name: c[order] for name, c in zip(("h", "class", "n", "deep", "pos"), columns, strict=True)})

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = unpack(batch.to_pandas())
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "class", "n", "deep", "pos"])

    dealt = own.where("n > 0").select("class", "n", "deep", "prefix").mapInArrow(deal, packed)
    by_block = dealt.where("block >= 0").groupBy("block").applyInPandas(repeated, POSTING)
    frequent = dealt.where("block < 0").mapInArrow(plain, POSTING).dropDuplicates(["h", "class", "n"])
    found = stored(by_block.unionByName(frequent), "postings")
    shared.destroy()
    return found


def _length_filter(small: str, large: str, percent: int) -> Column:
    return F.expr(f"100 * {small} >= {percent} * {large} and 100 * {large} >= {percent} * {small}")


def _needed(percent: int) -> str:
    """Overlap that a link of sets of n and m needs: 100 i >= percent (n + m - i)."""
    return f"ceil({percent} * (a_n + b_n) / {100 + percent}D)"


def _position_filter(percent: int) -> Column:
    """Bounds the overlap by what both sets can share before this n-gram, and by the shorter rest from it on.

    What they share before it is in both prefixes, so it is in more than one and counted in ``before`` of either.
    """
    return F.expr(f"least(a_before, b_before) + least(a_n - a_pos, b_n - b_pos) >= {_needed(percent)}")


def _ranked(postings: DataFrame, percent: int) -> DataFrame:
    """Adds before: how many n-grams of the prefix stand before this one and are in another prefix too.

    A set's first deep - 1 postings go.  So do those whose set has more n-grams before them that are in no other prefix than a link allows go at once.
    """
    ranked = postings.withColumn("before", F.expr("cast(row_number() over (partition by doc_id, deep order by pos) - 1 as int)"))
    return ranked.where(F.expr(f"before >= deep - 1 and 100 * (before + n - pos) >= {percent} * n"))


def _ranges_fit(percent: int) -> Column:
    """What two sets share in each hash range is at most the lesser count; the sum bounds the overlap."""
    return F.expr(f"coalesce(aggregate(zip_with(a_ranges, b_ranges, (x, y) -> least(x, y)), 0L, (s, x) -> s + x) >= {_needed(percent)}, true)")


def _suffix_filter(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    side = lambda name: reps.select(F.col("doc_id").alias(name), F.col("n").alias(f"{name}_n"), F.col("ranges").alias(f"{name}_ranges"))
    return pairs.join(side("b"), "b").join(side("a"), "a").where(_ranges_fit(percent)).select("a", "b")


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose doc_id is in ``ids``.

    A bit table of a bounded size, filled from all ids, lets other rows go before anything is shuffled.
    """
    bits = _power_of_two(BITS_EACH * ids.count(), LEAST_BITS, MOST_BITS)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = ids.select(place("doc_id").alias("p")).groupBy(F.expr("cast(p div 64 as int)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            p = batch.column("p").to_numpy()
            hit = (table[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
            if hit.any():
                yield batch.select(["doc_id", "text"]).filter(pa.array(hit))

    likely = texts.where("doc_id is not null").select("doc_id", "text", place("doc_id").alias("p")).mapInArrow(run, "doc_id long, text string")
    found = stored(likely.join(ids, "doc_id", "left_semi"), "near-texts")
    shared.destroy()
    return found


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole texts' sets link; each pair is given once and verified once."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    ids = stored(ids, "near-ids")
    near = _texts_of(ids, texts)
    side = lambda name: near.select(F.col("doc_id").alias(name), F.col("text").alias(f"{name}_text"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "b_text"):
                keys = part.column("a").to_numpy()
                # a leader's rows stand together; its set is made once for each run of them
                heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                texts_a = part.column("a_text").take(pa.array(heads))
                same = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(keys))))
                sets_b = shingle_sets(part.column("b_text"), width)
                linked = np.zeros(len(keys), bool)
                sets_a: dict[int, np.ndarray] = {}
                for i, own in enumerate(sets_b):
                    k = int(same[i])
                    if k not in sets_a:
                        sets_a = {k: shingle_sets(texts_a.slice(k, 1), width)[0]}
                    other = sets_a[k]
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    linked[i] = common > 0 and 100 * common >= percent * (len(own) + len(other) - common)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(linked))
        release()

    links = stored(both.mapInArrow(run, "a long, b long"), "links")
    dropped(ids, near)
    return links


_PLACE = ["n", "doc_id", "pos", "before"]


def _pairs_with_first(joined: DataFrame, percent: int) -> DataFrame:
    """Rows against their bucket's first, under the length and positional filters."""
    sides = [F.col(f"first.{c}").alias("a" if c == "doc_id" else f"a_{c}") for c in _PLACE] + [F.col(c).alias("b" if c == "doc_id" else f"b_{c}") for c in _PLACE]
    return joined.select(*sides).where("a != b").where(_length_filter("a_n", "b_n", percent)).where(_position_filter(percent)).select("a", "b").distinct()


def _by_leader(postings: DataFrame, percent: int) -> DataFrame:
    """Each bucket's members against its smallest set."""
    first = {"first": (F.min(F.struct(*_PLACE)), "min"), "size": (F.count("*"), "sum")}
    return _pairs_with_first(with_group(postings, ["h"], "doc_id", first, "size > 1"), percent)


def _mixed(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings, with their component and their bucket's size, of buckets that hold more than one component."""
    named = postings.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    values = {"least": (F.min("component"), "min"), "most": (F.max("component"), "max"), "size": (F.count("*"), "sum")}
    return with_group(named, ["h"], "doc_id", values, "least != most").drop("least", "most")


def _by_some(mixed: DataFrame, many: int, turn: int, percent: int) -> DataFrame:
    """Members against about ``many`` members of their bucket, where the components differ, under the length and positional filters.

    A hash of the document and the turn chooses these, so a bucket needn't be gathered to choose them, and those chosen in one
    bucket are likely to be chosen in others that they are in.
    """
    chosen = mixed.where(F.expr(f"pmod(xxhash64(doc_id, {turn}), 1000003) * size < 1000003D * {many}"))
    near = _length_filter("a_n", "b_n", percent) & _position_filter(percent)
    return _side(chosen, "a").join(_side(mixed, "b"), "h").where(F.expr("a_c != b_c") & near).select("a", "b").distinct()


def _side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    return rows.select("h", F.col("component").alias(f"{name}_c"), *[F.col(c).alias(name if c == "doc_id" else f"{name}_{c}") for c in [*_PLACE, *more]])


def _across(mixed: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components in what buckets are left, under all filters as they are joined.

    A pair comes once, from the first n-gram that both have among their first ``FIRST`` here; only a pair that shares
    none of these comes from each that it shares.
    """
    first = mixed.groupBy("doc_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("pos", "h"))), 1, FIRST).alias("_first"))
    about = reps.select("doc_id", "ranges").join(first.select("doc_id", F.col("_first.h").alias("hs")), "doc_id")
    wide = mixed.join(about, "doc_id")
    pairs = _side(wide, "a", "ranges", "hs").join(_side(wide, "b", "ranges", "hs"), "h").where("a < b and a_c != b_c")
    once = F.expr("coalesce(try_element_at(array_intersect(a_hs, b_hs), 1) = h, true)")
    return pairs.where(_length_filter("a_n", "b_n", percent) & _position_filter(percent) & _ranges_fit(percent) & once).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def join(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of all documents.

    component_id is the least doc_id that links lead to, the document's own included.
    """
    texts = _texts(docs, id_column, text_column)
    counts = frequencies(texts, width)
    own = profiles(texts, width, percent, counts)
    main = own.where("main")
    classes = stored(main.where("n > 0").groupBy("class", "n").agg(F.min("doc_id").alias("rep")), "classes")
    shared = shared_postings(own, counts)
    postings = stored(_ranked(shared.join(classes, ["class", "n"]).select("h", F.col("rep").alias("doc_id"), "n", "deep", "pos"), percent).drop("deep"), "postings")
    some = postings.select("doc_id").distinct()
    reps = stored(main.select("doc_id", "n", "ranges").join(some, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "ranges")

    dropped(shared)

    tried = labels = None
    for turn in range(len(SOME) + 2):
        mixed = None
        if turn == 0:
            candidates = _suffix_filter(_by_leader(postings, percent), reps, percent)
        else:
            mixed = stored(_mixed(postings, labels), "mixed")
            if not mixed.take(1):
                break
            candidates = _across(mixed, reps, percent) if turn > len(SOME) else _suffix_filter(_by_some(mixed, SOME[turn - 1], turn, percent), reps, percent)
        pairs = _ordered(candidates)
        if turn:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        dropped(mixed)
        tried = tried.unionByName(pairs) if turn else pairs
        found = verified(pairs, texts, width, percent)
        if turn and not found.take(1):
            continue
        # what was linked before is one link a document by now
        before, links = labels, found
        if turn:
            links = links.unionByName(before.select(F.col("id").alias("a"), F.col("component").alias("b")))
        labels = components(links)
        dropped(found, before)
    dropped(postings, reps)

    members = main.where("n > 0").select("doc_id", "n", "class").join(classes, ["class", "n"])
    named = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    full = named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    return full.unionByName(main.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the least doc_id stays.

    Rows are told apart by an own key and not by doc_id, so rows with a null doc_id, and rows that share
    one with different texts, stay unless they are near copies; a null doc_id comes after all others.
    """
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    found = join(keyed, width, percent, "_row").select(F.col("doc_id").alias("_row"), "component_id")
    named = keyed.select("_row", "doc_id").join(found, "_row")
    first = {"first": (F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")), "min")}
    kept = with_group(named, ["component_id"], "_row", first).where("_row = first._row").select("_row")
    return keyed.join(kept, "_row", "left_semi").select(*docs.columns)
