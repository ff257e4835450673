"""Hash splits, deterministic samples, and decontamination against held-out texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.functions.text import bucket, comparison_form, ngrams, tokens
from korale.session import stored

# Held-out books, and the shares of other rows.
TEST_BOOKS, VALIDATION_BOOKS = (8, 57, 65), (31, 37, 56, 63, 64)
VALIDATION_BOOKS_A = (31, 63, 64)
TEST_SHARE, VALIDATION_SHARE = 0.05, 0.05
NGRAM, CONTAINMENT = 10, 0.6
FEW_KEYS = 1_000_000  # hashes and keys up to which they are looked up through a broadcast


def _given(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def group_key(pub: bool = False) -> Column:
    """Rows that must stay together: a verse's book, else the document, the day, the publication, or the row alone."""
    keys = [F.when(F.col("content_type") == "bible_verse", F.concat(F.lit("bible_book_"), F.coalesce(F.col("book_num").cast("string"), F.lit("None")))),
            F.concat(F.lit("doc_"), _given("doc_id")), F.concat(F.lit("date_"), _given("text_date"))]
    if pub:
        keys.append(F.concat(F.lit("pub_"), _given("pub_code")))
    return F.coalesce(*keys, F.concat(F.lit("row_"), F.coalesce("id", F.lit(""))))


def hash_split(key: Column, test: float = TEST_SHARE, validation: float = VALIDATION_SHARE) -> Column:
    b, t = bucket(key, 10000), int(test * 10000)
    return F.when(b < t, "test").when(b < t + int(validation * 10000), "validation").otherwise("train")


def assign_split(pub: bool = False, validation_books: tuple[int, ...] = VALIDATION_BOOKS) -> Column:
    """The split of a pair: verses by book, all else by the hash of its group."""
    book = F.coalesce("book_num", F.lit(0))
    verse = F.when(book.isin(*TEST_BOOKS), "test").when(book.isin(*validation_books), "validation").otherwise("train")
    return F.when(F.col("content_type") == "bible_verse", verse).otherwise(hash_split(group_key(pub)))


def placed(rows: DataFrame, group: str, key: str, name: str) -> DataFrame:
    """rows with their place (from 1) within their group in the order of a hash of the key. Tasks order one hash prefix of a group each, and counts of prefixes give what comes before, so a group that holds a third of all rows is no hot task. Null groups are one group."""
    h = F.sha2(F.col(key).cast("string"), 256)
    rows = rows.withColumns({"_h": h, "_p": F.substring(h, 1, 3)})
    sums = rows.groupBy(F.col(group).alias("_g"), F.col("_p").alias("_q")).agg(F.count("*").alias("_k"))
    before = F.coalesce(F.sum("_k").over(Window.partitionBy("_g").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(sums.select("_g", "_q", before.alias("_before")), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_q")))
    place = F.row_number().over(Window.partitionBy(group, "_p").orderBy("_h", key)) + F.col("_before")
    return rows.withColumn(name, place).drop("_h", "_p", "_g", "_q", "_before")


def holdout(docs: DataFrame, stratum: str, key: str, share: float = 0.18) -> DataFrame:
    """A fixed share of each stratum, at least one row, in the order of a hash of the key; halves are rounded to even."""
    n = docs.groupBy(F.col(stratum).alias("_s")).agg(F.count("*").alias("_n"))
    ranked = placed(docs, stratum, key, "_r").join(n, F.col(stratum).eqNullSafe(F.col("_s")))
    return ranked.filter(F.col("_r") <= F.greatest(F.lit(1), F.bround(F.col("_n") * share, 0))).drop("_r", "_n", "_s")


def cap_share(rows: DataFrame, capped: Column, key: str, share: float) -> DataFrame:
    """At most so many capped rows that they make share of the result, the first in the order of a hash; all where there are fewer, or none of either kind."""
    flagged = rows.withColumn("_c", F.coalesce(capped, F.lit(False)))
    count = flagged.agg(F.count_if("_c").alias("_a"), F.count_if(~F.col("_c")).alias("_b"))
    # numbers of ordered rows, by the counts of hash prefixes: no single task sorts all capped rows
    prefixed = flagged.withColumn("_p", F.substring(F.sha2(F.col(key), 256), 1, 3))
    sums = prefixed.filter("_c").groupBy("_p").agg(F.count("*").alias("_k"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_k").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_k")
    place = F.row_number().over(Window.partitionBy("_p", "_c").orderBy(F.sha2(F.col(key), 256), key)) + F.coalesce("_before", F.lit(0))
    most = F.floor(F.lit(share / (1 - share)) * F.col("_b"))
    kept = prefixed.join(F.broadcast(before), "_p", "left").withColumn("_place", place).crossJoin(F.broadcast(count))  # one row of counts, at most 4096 prefixes
    return kept.filter(~F.col("_c") | (F.col("_a") == 0) | (F.col("_b") == 0) | (F.col("_place") <= most)).drop("_c", "_p", "_before", "_place", "_a", "_b")


def budget_prefix(rows: DataFrame, key: str, size: Column, budget: int) -> DataFrame:
    """Rows in the order of a hash of their key up to the first that would exceed the budget; the first row always."""
    rows = rows.withColumn("_s", size).withColumn("_h", F.sha2(F.col(key), 256))
    rows = rows.withColumn("_p", F.substring("_h", 1, 3))
    sums = rows.groupBy("_p").agg(F.sum("_s").alias("_k"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_k").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    reach = F.sum("_s").over(Window.partitionBy("_p").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    rows = rows.join(F.broadcast(before.drop("_k")), "_p").withColumn("_reach", reach)
    return rows.filter((F.col("_reach") <= budget) | (F.col("_reach") == F.col("_s"))).drop("_s", "_h", "_p", "_before", "_reach")


def quota_prefix(rows: DataFrame, group: str, key: str, size: Column, quota: int) -> DataFrame:
    """Per group, rows in key order while what came before stays below the quota."""
    w = Window.partitionBy(group).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum(size).over(w), F.lit(0))).filter(F.col("_before") < quota).drop("_before")


def split_documents(rows: DataFrame, held: DataFrame, key: str, validation_percent: int) -> DataFrame:
    """rows with a split, without those of held-out documents and without a document: a share of the documents, by hash, is validation."""
    left = rows.filter(F.col(key).isNotNull()).join(held.select(key), key, "left_anti")
    return left.withColumn("split", F.when(bucket(F.col(key), 100) < validation_percent, "validation").otherwise("train"))


def variant(key: Column, options: tuple[str, ...]) -> Column:
    """One of the options, by a hash of the key."""
    return F.get(F.array(*map(F.lit, options)), bucket(key, len(options)).cast("int"))


# --- decontamination


def sides(pairs: DataFrame, *keep: str) -> DataFrame:
    """One row per pair and side: id, side, form."""
    both = F.array(*[F.struct(F.lit(s).alias("side"), comparison_form(F.coalesce(s, F.lit(""))).alias("form")) for s in ("tvl", "en")])
    return pairs.select("id", *keep, F.inline(both))


def looked_up(keys: DataFrame) -> DataFrame:
    """keys for a semi or anti join: broadcast where they are few, which spares shuffling the texts."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def runs(k: int, *also: Column) -> Column:
    """Hashes of all runs of k of the words."""
    runs = F.transform(F.sequence(F.lit(1), F.size("words") - (k - 1)), lambda i: F.xxhash64(F.lit(k), *also, F.slice("words", i, F.lit(k))))
    return F.when(F.size("words") >= k, runs).otherwise(F.array().cast("array<bigint>"))


def _near(rows: DataFrame, texts: DataFrame, n: int, lead: int) -> DataFrame:
    """(id, side) of the rows that may share n words with a text, or the first `lead` ones of a shorter text of the same side; by hashes, so nothing is missed and a few are too many."""
    texts = texts.withColumn("words", tokens(F.col("form")))
    short = texts.filter(F.size("words").between(4, n - 1)).select(F.xxhash64(F.lit(lead), "side", F.slice("words", 1, lead)).alias("run"))
    index = texts.select(F.explode(runs(n)).alias("run")).unionByName(short).distinct()
    own = rows.select("id", "side", tokens(F.col("form")).alias("words")).select("id", "side", F.explode(F.concat(runs(n), runs(lead, F.col("side")))).alias("run"))
    return own.join(looked_up(index), "run", "left_semi").select("id", "side").distinct()


def contamination(train: DataFrame, held: DataFrame, n: int = NGRAM, containment: float = CONTAINMENT, exact: DataFrame | None = None) -> DataFrame:
    """id, side, level, matching, total: the first level on which a side of train meets held-out texts.

    Levels: the exact text, of `exact` if it is given; a shared n-gram of either
    side; or, for held-out texts of 4 to n - 1 words of the same side, its words
    in a row, or a run of more than `containment` of them from its first word on.
    """
    rows, texts = sides(train), sides(held).select("side", "form").distinct()
    hashes = looked_up((texts if exact is None else sides(exact)).select(F.sha2("form", 256).alias("h")).distinct())
    rows = rows.withColumn("h", F.sha2("form", 256))
    hit = _exact(rows, hashes)
    rest = rows.join(hashes, "h", "left_anti").filter("form != ''").drop("h")
    # few rows are near enough to be compared; their texts alone are shuffled
    near = stored(_near(rest, texts, n, min(_lead(k, containment) for k in range(4, n))), "near")
    rest = rest.join(looked_up(near), ["id", "side"], "left_semi").distinct()
    index = texts.select(F.explode(ngrams(tokens(F.col("form")), n)).alias("gram")).distinct()
    own = rest.select("id", "side", F.explode(ngrams(tokens(F.col("form")), n)).alias("gram")).distinct()
    total = own.groupBy("id", "side").agg(F.count("*").alias("total"))
    met = own.join(index, "gram", "left_semi").groupBy("id", "side").agg(F.count("*").alias("matching"))
    overlap = met.join(total, ["id", "side"]).select("id", "side", F.lit("ngram_overlap").alias("level"), "matching", "total")
    rest = rest.join(overlap.select("id", "side"), ["id", "side"], "left_anti")
    # a containing text has the first words of the short one in a row, which makes this an equality join
    short = texts.withColumn("words", tokens(F.col("form"))).filter(F.size("words").between(4, n - 1))
    lead = F.greatest(F.lit(1), F.floor(F.lit(containment) * F.size("words")).cast("int") + 1)
    short = short.select("side", "words", lead.alias("lead"), F.array_join(F.slice("words", F.lit(1), lead), " ").alias("key")).distinct()
    words = tokens(F.col("form"))
    runs = [rest.select("id", "side", F.explode(ngrams(words, k)).alias("key"), F.lit(k).alias("lead")) for k in sorted({_lead(m, containment) for m in range(4, n)})]
    every = runs[0]
    for r in runs[1:]:
        every = every.unionByName(r)
    inside = every.join(short, ["side", "key", "lead"], "left_semi").select("id", "side").distinct()
    inside = inside.select("id", "side", F.lit("high_containment").alias("level"), F.lit(None).cast("bigint").alias("matching"), F.lit(None).cast("bigint").alias("total"))
    return hit.unionByName(overlap).unionByName(inside)


def _lead(words: int, containment: float) -> int:
    """The first words of a short text that another must have in a row."""
    return max(1, int(containment * words) + 1)


def _exact(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The sides of rows (id, side, form, h) whose hash is listed, in the columns of contamination()."""
    hit = rows.join(hashes, "h", "left_semi").select("id", "side", "h").distinct()
    return hit.select("id", "side", F.lit("exact_match").alias("level"), F.lit(None).cast("bigint").alias("matching"), F.lit(None).cast("bigint").alias("total"))


def decontamination(train: DataFrame, held: DataFrame, n: int = NGRAM, containment: float = CONTAINMENT) -> DataFrame:
    """contamination() of all training rows (id, content_type, tvl, en): the exact text of any held-out row, and for rows that aren't verses also the n-grams and short texts of held-out verses."""
    verse = F.coalesce(F.col("content_type") == "bible_verse", F.lit(False))
    hashes = looked_up(sides(held).select(F.sha2("form", 256).alias("h")).distinct())
    verses = _exact(sides(train.filter(verse)).withColumn("h", F.sha2("form", 256)), hashes)
    return contamination(train.filter(~verse), held.filter(verse), n, containment, held).unionByName(verses)


def groups_in_several_splits(pairs: DataFrame, key: Column) -> DataFrame:
    """Groups whose rows stand in more than one split."""
    return pairs.groupBy(key.alias("group_key")).agg(F.count_distinct("split").alias("splits"), F.count("*").alias("rows")).filter("splits > 1")
