"""Stored indexes: which files hold an id, and which names hold a word or one much like it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapsheaf.operators.lookup import SEARCH_RESULTS, SHORTEST_QUERY, feature_lookup
from mapsheaf.operators.tags import feature_label
from mapsheaf.sources.release import scan_files

# Folders of an id index; a lookup reads those of its ids only.
ID_BUCKETS = 256
# Ids of a lookup are broadcast up to this many, counted first.
BROADCAST_IDS = 1_000_000


def _bucket(id_: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(buckets)).cast("int")


def write_id_index(features: DataFrame, out: str, buckets: int = ID_BUCKETS) -> None:
    """Write which files of a scanned release hold each id, in folders by hash of the id."""
    rows = features.select(_bucket(F.col("id"), buckets).alias("bucket"), "id", "filename").where("id is not null").distinct()
    rows.repartitionByRange("bucket", "id").sortWithinPartitions("bucket", "id").write.mode(
        "overwrite").partitionBy("bucket").parquet(out)


def indexed_files(spark: SparkSession, index: str, ids: DataFrame, buckets: int = ID_BUCKETS) -> DataFrame:
    """``filename`` of every file that holds one of ``ids``.

    Only the folders of the ids' buckets are read; the driver gets their numbers, ``buckets`` at most.
    """
    wanted = ids.select("id").where("id is not null").distinct().withColumn("bucket", _bucket(F.col("id"), buckets))
    touched = {r.bucket: r.n for r in wanted.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    if sum(touched.values()) <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    held = spark.read.parquet(index).where(F.col("bucket").isin(*touched))
    return held.join(wanted, ["bucket", "id"]).select("filename").distinct()


def indexed_lookup(spark: SparkSession, root: str, index: str, ids: DataFrame,
                   buckets: int = ID_BUCKETS, schema=None, columns: list[str] | None = None) -> DataFrame | None:
    """``feature_lookup`` that reads only the files of a release in which the index finds the ids.

    The driver holds the names of those files, as any scan of them does; None if there are none.
    """
    found = scan_files(spark, root, [r.filename for r in indexed_files(spark, index, ids, buckets).collect()], schema)
    return None if found is None else feature_lookup(found, ids, columns)


def _words(text: Column) -> Column:
    """Distinct folded words: runs of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def _grams(word: Column) -> Column:
    """Distinct runs of three characters, with two blanks before and after the word."""
    padded = F.concat(F.lit("  "), word, F.lit("  "))
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(word) + 2), lambda at: F.substring(padded, at, F.lit(3))))


def write_name_index(features: DataFrame, out: str, results: int = SEARCH_RESULTS) -> None:
    """Write the words of all names, their trigrams, and the features that carry them.

    ``grams`` has one row per trigram of a distinct word, ``postings`` one per word of a name, ``leaders``
    the first ``results`` of each word by name and id, kept per task before they are shuffled.
    """
    columns = ["id", "theme", "type", "subtype", "name"]
    named = features.withColumn("name", feature_label(features)).where("name is not null").select(columns)
    posted = named.withColumn("words", _words(F.col("name"))).withColumn("word", F.explode("words"))
    posted.repartitionByRange("word", "name", "id").sortWithinPartitions("word", "name", "id").write.mode(
        "overwrite").parquet(f"{out}/postings")
    postings = features.sparkSession.read.parquet(f"{out}/postings")
    counted = postings.groupBy("word").agg(F.count("*").alias("carried"))
    counted.withColumn("grams", _grams(F.col("word"))).select(
        F.explode("grams").alias("gram"), "word", "carried").repartitionByRange("gram", "word").sortWithinPartitions(
        "gram", "word").write.mode("overwrite").parquet(f"{out}/grams")
    first = Window.partitionBy("word").orderBy(F.lower("name"), "name", "id")
    postings.withColumn("place", F.row_number().over(first)).where(F.col("place") <= results).drop("place").write.mode(
        "overwrite").parquet(f"{out}/leaders")


def similar_words(grams: DataFrame, words: DataFrame, errors: int) -> DataFrame:
    """``asked, word, carried, errors``: the indexed words at most so many edits from each of ``words`` (``asked``).

    An edit changes three trigrams at most, so words that near share all but ``3 * errors`` of the
    asked word's; of a word of two letters and one edit, still the one at its start or end. An edit changes
    the length by one at most.
    """
    asked = words.select("asked", F.explode(_grams(F.col("asked"))).alias("gram"), F.size(_grams(F.col("asked"))).alias("own"))
    alike = F.abs(F.length("asked") - F.length("word")) <= errors
    near = grams.join(asked, "gram").where(alike).groupBy("asked", "word", "carried", "own").agg(F.count("*").alias("shared"))
    distance = F.levenshtein("asked", "word", errors)
    return near.where(F.col("shared") >= F.col("own") - 3 * errors).withColumn("errors", distance).where(
        F.col("errors") >= 0).select("asked", "word", "carried", "errors")


def indexed_search(spark: SparkSession, index: str, queries: DataFrame, errors: int = 1,
                   results: int = SEARCH_RESULTS) -> DataFrame:
    """The best names for each query, with up to ``errors`` wrong letters in each of its words.

    ``queries`` has ``query_id`` and ``text``. Every word of a query must be like some word of the name,
    wherever that stands. Fewest wrong letters come first, then names and ids in order. Words of one letter
    are taken as they are. A query of one word needs only the leaders of the words like it. For several, the
    distinct names that hold a word like the one fewest names carry are compared with the other words,
    and only of the best names the first features are looked up.
    """
    grams, postings, leaders = (spark.read.parquet(f"{index}/{t}") for t in ("grams", "postings", "leaders"))
    texts = queries.where(F.length("text") >= SHORTEST_QUERY).select("text").distinct().withColumn("asked_words", _words(F.col("text")))
    asked = texts.select("text", "asked_words", F.explode("asked_words").alias("asked"))
    words = asked.select("asked").distinct()
    near = similar_words(grams, words.where(F.length("asked") > 1), errors).unionByName(
        grams.join(words.where(F.length("asked") == 1), F.col("word") == F.col("asked")).select(
            "asked", "word", "carried", F.lit(0).alias("errors")).distinct())
    rarest = near.groupBy("asked").agg(F.sum("carried").alias("carried"))
    lead = asked.join(rarest, "asked").groupBy("text", "asked_words").agg(
        F.min_by("asked", F.struct("carried", "asked")).alias("asked"), F.count("*").alias("known"))
    lead = lead.where(F.col("known") == F.size("asked_words")).join(near.drop("carried"), "asked")
    single = F.size("asked_words") == 1
    feature = ["id", "theme", "type", "subtype", "name"]

    def fewest(asked: Column) -> Column:
        """Wrong letters of the word of the name most like it; null if none is like it."""
        allowed = F.when(F.length(asked) > 1, errors).otherwise(0)
        return F.array_min(F.filter(
            F.transform("words", lambda word: F.levenshtein(asked, word)), lambda n: n <= allowed))

    def judged(hits: DataFrame) -> DataFrame:
        return hits.withColumn("each", F.transform("asked_words", fewest)).where(~F.exists("each", F.isnull)).withColumn(
            "errors", F.aggregate("each", F.lit(0), lambda total, n: total + n))

    first = judged(lead.where(single).join(leaders.select("word", "words", *feature), "word")).select("text", *feature, "errors")

    # A name that many features carry is compared once; the best features carry the best names.
    several = lead.where(~single)
    names = postings.join(several.select("word").distinct(), "word", "left_semi").select("word", "name", "words").distinct()
    named = judged(several.join(names, "word")).groupBy("text", "name").agg(
        F.min("errors").alias("errors"), F.min("word").alias("word"))
    leading = Window.partitionBy("text").orderBy("errors", F.lower("name"), "name")
    named = named.withColumn("place", F.row_number().over(leading)).where(F.col("place") <= results).drop("place")
    carriers = postings.join(named.select("word", "name").distinct(), ["word", "name"], "left_semi").select(feature).distinct()
    by_id = Window.partitionBy("name").orderBy("id")
    carriers = carriers.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= results).drop("place")
    others = named.join(carriers, "name").select("text", *feature, "errors")

    features = first.unionByName(others).groupBy("text", *feature).agg(F.min("errors").alias("errors"))
    best = Window.partitionBy("text").orderBy("errors", F.lower("name"), "name", "id")
    found = features.withColumn("position", F.row_number().over(best)).where(F.col("position") <= results)
    return queries.select("query_id", "text").join(found, "text")
