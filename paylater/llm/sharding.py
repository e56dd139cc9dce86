"""Shards of near-equal size by sampled splitters.

1. **Keys.**  A record's key is ``(hash of its text, id)``: equal texts are neighbours, and a group of copies of any
   size can still be divided by id.  Rows that repeat both are one record with a number of copies.
2. **Splitters.**  A sample takes each record with a probability in proportion to its size (large records
   several times).  Quantiles of the sampled keys are the boundaries of the ranges.
3. **Overfull ranges.**  Every record is counted into its range.  Ranges of more than ``OVERFULL`` times the usual
   number of records (many small texts) are sampled again, record by record, and divided, until none is left.
4. **Places.**  Sums of whole ranges come before the ranges; within a range a window adds up its
   records.  So each record knows the exact bytes and rows before it in key order, and
   its shard is the share of the total that they are: shards differ by one record at most.
5. **Slots.**  A record's place among all less the first place of its shard.

Built-in functions only.  Texts are read once, to narrow rows (ids, hashes, sizes); these are shuffled.
What is collected is the sample (about ``SAMPLES`` a range) and one row for each range (``RANGES`` at most, and
twice as many after dividing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.tables import written

SHARDS = 16
RECORDS_IN_RANGE = 2_000
LEAST_RANGES = 64
RANGES = 4_096
SAMPLES = 16                   # sampled records for each range
OVERFULL = 4
ROUNDS = 12
COPIES = 10_000                # rows that one row of repeated records becomes at a time
NO_ID = -(1 << 63)
LAWS = ("bytes", "rows")


def _records(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``h, doc_id, size, text_crc32, copies``: one row for equal ids and texts."""
    body = documents.text_bytes(text_col)
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.octet_length(body).cast("bigint").alias("bytes"),
                       F.xxhash64(body).alias("h"), F.crc32(body).alias("text_crc32"))
    return (rows.groupBy("h", "doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32")
            .agg(F.count("*").alias("copies")))


def _key() -> tuple[Column, Column]:
    return F.col("h"), F.coalesce("doc_id", F.lit(NO_ID))


def _longs(values: list[int]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _search(n: int, reached) -> Column:
    """How many of ``n`` sorted constants are reached, by halving; ``reached`` takes a place from 1 on."""
    steps = _longs([1 << b for b in range(n.bit_length() - 1, -1, -1)]).cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda place, step: F.when(
        (place + step <= n) & reached(F.least(place + step, F.lit(n))), place + step).otherwise(place))


def range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters that are not above the record's key."""
    if not splitters:
        return F.lit(0)
    hashes, ids = (_longs([s[k] for s in splitters]) for k in (0, 1))
    h, i = _key()

    def reached(place: Column) -> Column:
        at_h, at_i = F.element_at(hashes, place), F.element_at(ids, place)
        return (at_h < h) | ((at_h == h) & (at_i <= i))

    return _search(len(splitters), reached)


def share_of(start: Column, total: int, shards: int) -> Column:
    """Which of ``shards`` equal shares of ``total`` a place lies in."""
    if shards < 2:
        return F.lit(0)
    bounds = _longs([-(-total * s // shards) for s in range(1, shards)])
    return _search(shards - 1, lambda place: F.element_at(bounds, place) <= start)


def _sample(records: DataFrame, weight: Column, rate: float, seed: int, *keep: str) -> DataFrame:
    """Records with the number of times that each is taken: ``weight * rate`` on average, by a hash of the key."""
    expected = weight.cast("double") * F.lit(rate)
    chance = F.pmod(F.xxhash64(*_key(), F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    picks = (F.floor(expected) + (chance < expected - F.floor(expected)).cast("bigint")).alias("picks")
    h, i = _key()
    return records.select(*keep, h.alias("h"), i.alias("i"), picks).where("picks > 0")


def quantile_keys(sample: DataFrame, pieces: Column, by: list[str]) -> DataFrame:
    """Keys at which a sample passes a share of ``1 / pieces`` of its picks, for each group of ``by``.

    The sample is bounded (module docstring), so one task may order it.
    """
    order = Window.partitionBy(*by).orderBy("h", "i") if by else Window.orderBy("h", "i")
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    reached = F.sum("picks").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = sample.select("*", reached.alias("reached"), F.sum("picks").over(whole).alias("all"))
    share = lambda c: F.floor(c * pieces / F.col("all"))        # noqa: E731
    return placed.where(share(F.col("reached")) > share(F.col("reached") - F.col("picks"))).select("h", "i")


def splitters(records: DataFrame, weight: Column, n_records: int, total: int) -> tuple[list[tuple[int, int]], dict]:
    """Sorted splitter keys, and ``range: (records, rows, weight)`` of the ranges that hold any."""
    ranges = max(LEAST_RANGES, min(RANGES, n_records // RECORDS_IN_RANGE))
    first = _sample(records, weight, ranges * SAMPLES / max(total, 1), 0)
    cuts = {tuple(r) for r in quantile_keys(first, F.lit(ranges), []).collect()}
    usual = max(n_records // ranges, 1)
    for round_ in range(1, ROUNDS + 1):
        keys = sorted(cuts)
        counted = (records.groupBy(range_of(keys).alias("range_id"))
                   .agg(F.count("*").alias("records"), F.sum("copies").alias("rows"), F.sum(weight).alias("weight")))
        held = {r.range_id: (r.records, r.rows, r.weight) for r in counted.collect()}
        full = {k: v[0] for k, v in held.items() if v[0] > OVERFULL * usual}
        if not full or round_ == ROUNDS:
            return keys, held
        # taken record by record this time: about SAMPLES for each usual number of records
        again = _sample(records.withColumn("range_id", range_of(keys)).where(F.col("range_id").isin(*full)),
                        F.lit(1), SAMPLES / usual, round_, "range_id")
        pieces = F.create_map(*[F.lit(x) for k, n in full.items() for x in (k, -(-n // usual))])
        new = {tuple(r) for r in quantile_keys(again.withColumn("pieces", pieces[F.col("range_id")]),
                                               F.col("pieces"), ["range_id"]).collect()}
        if new <= cuts:
            return keys, held
        cuts |= new
    raise AssertionError("unreachable")


def shard_documents(docs: DataFrame, shards: int = SHARDS, law: str = "bytes", id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs``, one for one.

    ``law`` ``bytes``: the bytes of a shard (UTF-8 and one more for each row) are an equal share, give or take one
    record.  ``rows``: shards differ by one row at most.  ``slot`` counts a shard's rows from 0, by text hash,
    then id.  A null text has no bytes; rows without an id come first among equal texts; of rows that repeat id and
    text each is a record of its own.  An empty table has no rows.  Other columns are not read.
    """
    if law not in LAWS:
        raise ValueError(f"law is one of {LAWS}")
    records = written(_records(docs, id_col, text_col), "shard-records")
    unit = F.col("size") if law == "bytes" else F.lit(1).cast("bigint")
    weight = unit * F.col("copies")
    size = records.agg(F.count("*").alias("records"), F.sum("copies").alias("rows"), F.sum(weight).alias("weight"),
                       F.max("copies").alias("most")).first()
    total = size.weight or 0
    keys, held = splitters(records, weight, size.records, total)
    rows_ahead, weight_ahead = [0], [0]
    for k in range(len(keys)):
        _, rows, weights = held.get(k, (0, 0, 0))
        rows_ahead.append(rows_ahead[-1] + rows)
        weight_ahead.append(weight_ahead[-1] + weights)
    inside = (Window.partitionBy("range_id").orderBy("h", F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    ahead = lambda sums: F.element_at(_longs(sums), F.col("range_id") + 1)       # noqa: E731
    placed = (records.withColumn("range_id", range_of(keys))
              .select("doc_id", "size", "text_crc32", "copies", unit.alias("unit"),
                      (ahead(rows_ahead) + F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("place"),
                      (ahead(weight_ahead) + F.coalesce(F.sum(weight).over(inside), F.lit(0))).alias("start")))
    if (size.most or 0) > COPIES:
        # a record of very many copies is dealt over tasks before it becomes rows
        placed = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                                F.floor((F.col("copies") - 1) / COPIES))))
        placed = placed.repartition("place", "part")
        first = F.col("part") * COPIES
        last = F.least(first + COPIES, F.col("copies")) - 1
    else:
        first, last = F.lit(0).cast("bigint"), F.col("copies") - 1
    copies = placed.withColumn("copy", F.explode(F.sequence(first, last)))
    # a record lies where its middle lies
    middle = 2 * (F.col("start") + F.col("copy") * F.col("unit")) + F.col("unit")
    dealt = written(copies.select(
        "doc_id", "size", "text_crc32", (F.col("place") + F.col("copy")).alias("place"),
        share_of(middle, 2 * total, shards).alias("shard")), "shard-places")
    held_by = dealt.groupBy("shard").agg(F.min("place").alias("first_place"))          # one row for each shard
    return (dealt.join(F.broadcast(held_by), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first_place")).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, law: str = "bytes", id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """One folder ``shard=N`` for each shard under ``path``, holding ``slot, doc_id, text`` by slot."""
    body = documents.text_bytes(text_col)
    texts = (docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.crc32(body).alias("text_crc32"),
                         (F.octet_length(body) + 1).cast("bigint").alias("size"), docs[text_col].alias("text"))
             .groupBy("doc_id", "text_crc32", "size").agg(F.min("text").alias("text")))
    placed = shard_documents(docs, shards, law, id_col, text_col)
    key = [placed[c].eqNullSafe(texts[c]) for c in ("doc_id", "text_crc32", "size")]
    (placed.join(texts, key, "left").select(placed["shard"], placed["slot"], placed["doc_id"], "text")
     .hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in sixteen shards of near-equal bytes."""
    placed = shard_documents(documents.read(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
