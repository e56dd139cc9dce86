"""Order MinHash fingerprints of texts, with built-in functions only.

1. Every string of ``K`` bytes of a text (a k-mer) is hashed, and numbered among its equals:
   the third occurrence of a k-mer is another element than the second.
2. The elements' hashes are a random order of them, cut into ``BINS`` ranges.
   The two smallest elements of each range are one sample, kept in text order:
   their hashes in that order make one component.
3. Two fingerprints are alike by their share of equal components.  A component is
   equal only if both its elements, and their order, are; moving text changes it, as it changes the
   edit distance.

Arrays of longs hold hash and position of an element, so that sorting them is
the built-in sort of numbers.  In longer texts only elements in the lower part of each range are
kept after the first sort; if some range then has fewer than two, the row
is done again with all of them, so the result doesn't depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylater.llm import documents

K = 16
BIN_BITS = 6
BINS = 1 << BIN_BITS
POSITION_BITS = 26                     # texts of up to 64 MiB
HASH_BITS = 64 - POSITION_BITS
INNER = 1 << HASH_BITS - BIN_BITS      # hash values in one range
EXPECTED = 16                          # elements kept in each range of a longer text, on average
MOST_BUCKETS = 4096
ROWS_IN_BUCKET = 1000


def _let(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once, and not again for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hash(x: Column) -> Column:
    return F.shiftrightunsigned(x, POSITION_BITS)


def _range(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def _kmers(body: Column) -> Column:
    """Hash and position of every k-mer as one long; a shorter text is one k-mer."""
    low = (1 << POSITION_BITS) - 1
    return _let(body, lambda b: F.when(F.length(b) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(b) - (K - 1))),
        lambda i: F.xxhash64(F.substring(b, i, F.lit(K))).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint")))))


def _same(x: Column, y: Column) -> Column:
    """Equal hashes; false beside the array's ends."""
    return F.shiftrightunsigned(x.bitwiseXOR(y), POSITION_BITS).eqNullSafe(F.lit(0).cast("bigint"))


def _low(x: Column, limit: Column) -> Column:
    """In the lower part of its range; ``limit`` is that part's size, shifted like a hash."""
    return x.bitwiseAND(F.lit((INNER - 1) << POSITION_BITS)) < limit


def _candidates(ordered: Column, limit: Column) -> Column:
    """Of sorted k-mers, those that occur again, and those low in their range."""
    return _let(ordered, lambda s: F.filter(
        s, lambda x, i: _low(x, limit) | _same(x, F.get(s, i + 1)) | _same(x, F.get(s, i - 1))))


def _numbered(candidates: Column, limit: Column) -> Column:
    """Elements: hash of k-mer and occurrence number, with the position.  A first occurrence keeps its k-mer's hash."""
    low = (1 << POSITION_BITS) - 1

    def number(c: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(c) - 1),
                          lambda i: (i == 0) | ~_same(F.get(c, i), F.get(c, i - 1)))

        def runs(s: Column) -> Column:
            return F.flatten(F.transform(s, lambda at, r: F.transform(
                F.slice(c, at + 1, F.coalesce(F.get(s, r + 1), F.size(c)) - at),
                lambda x, j: F.when(j == 0, x).otherwise(
                    F.xxhash64(_hash(x), j).bitwiseAND(F.lit(~low)).bitwiseOR(x.bitwiseAND(F.lit(low)))))))
        return F.filter(_let(starts, runs), lambda x: _low(x, limit))

    def split(c: Column, again: Column) -> Column:
        single = F.filter(c, lambda x, i: ~(_same(x, F.get(c, i + 1)) | _same(x, F.get(c, i - 1))))
        return F.when(F.size(again) == 0, c).otherwise(
            F.concat(single, F.when(F.size(again) == 0, again).otherwise(number(again))))
    return _let(candidates, lambda c: _let(
        F.filter(c, lambda x, i: _same(x, F.get(c, i + 1)) | _same(x, F.get(c, i - 1))),
        lambda again: split(c, again)))


def _smallest(elements: Column) -> Column:
    """The two smallest elements of each range, of sorted elements."""
    return _let(elements, lambda e: F.filter(
        e, lambda x, i: (i < 2) | (F.shiftrightunsigned(
            x.bitwiseXOR(F.get(e, i - 2)), 64 - BIN_BITS) != 0)))


def _components(chosen: Column) -> Column:
    """A component for each range that has elements: the range and the hash of its elements in text order."""
    low = (1 << POSITION_BITS) - 1
    place = lambda x: x.bitwiseAND(F.lit(low))

    def of(c: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(c) - 1),
                          lambda i: (i == 0) | (_range(F.get(c, i)) != _range(F.get(c, i - 1))))

        def one(a: Column, b: Column) -> Column:
            single = b.isNull() | (_range(a) != _range(b))
            pair = F.when(single, F.xxhash64(_hash(a))).when(
                place(a) < place(b), F.xxhash64(_hash(a), _hash(b))).otherwise(F.xxhash64(_hash(b), _hash(a)))
            return F.concat(F.lpad(F.hex(_range(a)), 2, "0"), F.substring(F.lpad(F.hex(pair), 16, "0"), 1, 8))
        return F.transform(firsts, lambda i: one(F.get(c, i), F.get(c, i + 1)))
    return _let(chosen, lambda c: F.when(F.size(c) == 0, F.array().cast("array<string>")).otherwise(of(c)))


def with_fingerprint(df: DataFrame, body: str, name: str) -> DataFrame:
    """``df`` with the components of the binary column ``body`` as an array of strings, ``name``."""
    every = F.lit(INNER << POSITION_BITS)
    # Each step is a projection of its own: an expression under a lambda would be evaluated for each element.
    out = df.withColumn("_s", F.sort_array(_kmers(F.col(body))))
    share = F.ceil(F.lit(float(INNER * EXPECTED * BINS)) / F.greatest(F.size("_s"), F.lit(1)))
    out = out.withColumn("_limit", F.shiftleft(F.least(F.lit(INNER), share), POSITION_BITS))
    out = out.withColumn("_e", F.sort_array(_numbered(_candidates(F.col("_s"), F.col("_limit")), F.col("_limit"))))
    out = out.withColumn("_c", _smallest(F.col("_e")))
    again = _smallest(F.sort_array(_numbered(F.col("_s"), every)))
    out = out.withColumn("_c", F.when((F.size("_c") < 2 * BINS) & (F.col("_limit") < every), again)
                         .otherwise(F.col("_c")))
    return out.withColumn(name, _components(F.col("_c"))).drop("_s", "_limit", "_e", "_c")


def likeness(a: str, b: str) -> Column:
    """Square root (components are pairs) of the share of equal components among the ranges that either has; 0 to 1."""
    ranges = lambda c: F.transform(F.col(c), lambda x: F.substring(x, 1, 2))
    every = F.size(F.array_union(ranges(a), ranges(b)))
    return F.when(every == 0, 1.0).otherwise(F.sqrt(F.size(F.array_intersect(a, b)) / every))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, fingerprint, next_text, next_fingerprint``; after the last id comes the first.

    Ids are dealt into ranges of about equal numbers of rows, which one shuffle
    brings together.  Only the first document of each range (``MOST_BUCKETS`` at most)
    is looked up once more, for the last of the range before.
    """
    ids = docs.select("doc_id")
    rows = ids.count()
    n = min(MOST_BUCKETS, rows // ROWS_IN_BUCKET + 1)
    cuts = []
    if n > 1:
        cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n)).first()[0]))
    edges = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    bucket = F.size(F.filter(edges, lambda c: c < F.col("doc_id")))
    dealt = docs.withColumn("bucket", bucket).repartition("bucket")
    in_order = Window.partitionBy("bucket").orderBy("doc_id", "text")
    by_id = Window.partitionBy("bucket").orderBy("doc_id")
    once = (dealt.withColumn("again", F.lag("doc_id").over(in_order) == F.col("doc_id"))
            .where("again is null or not again").drop("again"))
    printed = with_fingerprint(once.withColumn("body", F.col("text").cast("binary")), "body", "fingerprint").drop("body")
    led = printed.withColumns({"next_text": F.lead("text").over(by_id),
                               "next_fingerprint": F.lead("fingerprint").over(by_id),
                               "last": F.lead("doc_id").over(by_id).isNull()})

    # Ranges with rows, in order; the range after the last is the first.
    firsts = ids.withColumn("bucket", bucket).groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    after = Window.orderBy("bucket")
    follow = firsts.select("bucket", F.coalesce(F.lead("first_id").over(after), F.min("first_id").over(
        after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("doc_id"))
    heads = (docs.join(F.broadcast(follow), "doc_id").groupBy("bucket").agg(F.min("text").alias("head_text")))
    heads = with_fingerprint(heads.withColumn("body", F.col("head_text").cast("binary")), "body", "head_fingerprint")
    joined = led.join(heads.drop("body"), "bucket", "left")
    return joined.select(
        "doc_id", "text", "fingerprint",
        F.when(F.col("last"), F.col("head_text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(F.col("last"), F.col("head_fingerprint")).otherwise(F.col("next_fingerprint")).alias("next_fingerprint"))


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to that and to the next document.

    ``doc_id, n_chars, edited, fingerprint, edited_fingerprint`` (arrays of components),
    ``near_edited, near_next``.  The edited text has the first characters of the next document, by id, in place
    of its own last half.  Null texts are empty; rows without an id are left out; of
    rows with one id the smallest text counts.  Two texts without components are alike (1).
    """
    clean = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    pairs = (with_next(clean).withColumn("n_chars", F.char_length("text").cast("long"))
             .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                            F.substring("next_text", F.lit(1), half)))
             .select("doc_id", "n_chars", "fingerprint", "next_fingerprint", "edited",
                     F.col("edited").cast("binary").alias("body")))
    printed = with_fingerprint(pairs, "body", "edited_fingerprint")
    return printed.select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
                          likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                          likeness("fingerprint", "next_fingerprint").alias("near_next"))


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with their likeness."""
    out = edited_neighbours(documents.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      F.array_join("fingerprint", "").alias("fingerprint"),
                      F.array_join("edited_fingerprint", "").alias("edited_fingerprint"), "near_edited", "near_next")
