"""Chart inputs derived from the sales tables (lineitem, part).

Every part is a song and every week ranks all parts sold that week by quantity,
so the chart grows with the tables. FIXTURES.md describes the target shapes.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upcharts.session import table_path

# Primary act behind a third of all songs, to keep a hot key in the data
HOUSE_ACT = "House Ensemble"

# songs per rank block; bounds every ranking group
_RANK_BLOCK = 100_000

# a song away for longer debuts again
_AWAY_WEEKS = 52

# every so manieth song lacks the field, as some documents do
_NO_WEEKS = 47
_NO_LAST_POS = 31


def _saturday(d: Column) -> Column:
    return F.next_day(F.date_sub(d, 1), "SAT")


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Rows of lineitem, which bound the chart rows; only file footers are read."""
    return spark.read.parquet(table_path(sf_dir, "lineitem")).count()


def weekly_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per (week, part)."""
    lines = spark.read.parquet(table_path(sf_dir, "lineitem"))
    week = _saturday(F.col("l_shipdate").cast("date"))
    return lines.groupBy(week.alias("chart_date"), F.col("l_partkey").alias("song_key")).agg(
        F.sum("l_quantity").cast("long").alias("volume")
    )


def rank_within_week(volumes: DataFrame) -> DataFrame:
    """Exact position by (volume desc, song_key) within each week.

    A plain ``row_number`` over the week would sort a whole week in one task.
    Rows are instead numbered inside (week, volume, block of song keys), which
    holds at most ``_RANK_BLOCK`` rows, and shifted by the size of the groups
    ahead of them.
    """
    group = ["chart_date", "volume", "block"]
    # never NULL, so the join below adds no filter on it and both of its sides
    # read one shuffle of the volumes
    block = F.coalesce(F.floor(F.col("song_key") / _RANK_BLOCK), F.lit(0))
    rows = volumes.withColumn("block", block)
    ahead = Window.partitionBy("chart_date").orderBy(F.desc("volume"), "block")
    groups = (
        rows.groupBy(*group)
        .agg(F.count("*").alias("size"))
        .withColumn("upto", F.sum("size").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
        .select(*group, (F.col("upto") - F.col("size")).alias("ahead"))
    )
    place = F.row_number().over(Window.partitionBy(*group).orderBy("song_key"))
    return (
        rows.withColumn("place", place)
        .join(groups, group)
        .select("chart_date", "song_key", (F.col("ahead") + F.col("place")).cast("int").alias("rank"))
    )


def _lead_act() -> Column:
    number = F.floor(F.col("p_partkey") / 100)
    return (
        F.when(F.col("p_type").isin("ECONOMY", "PROMO"), F.lit(HOUSE_ACT))
        .when(F.col("p_brand") == "Brand#13", F.lit("J. Cole"))
        .otherwise(F.concat("p_brand", F.lit(" Act "), number.cast("string")))
    )


# collaboration suffix by the second word of the part name
_CREDIT_SUFFIX = {
    "bolt": " & Friends",
    "gizmo": " With Strings",
    "plate": ", The Band",
    "ring": " Featuring Guest",
    "rod": " x Echo",
}


def _credit() -> Column:
    word = F.split("p_name", " ")[1]
    suffix = F.coalesce(
        *[F.when(word == w, F.lit(s)) for w, s in _CREDIT_SUFFIX.items()], F.lit("")
    )
    return F.concat(_lead_act(), suffix)


# tags by brand number modulo 8, with tags the allowlist must drop
BRAND_TAGS = (
    ("pop", "dance-pop", "2010s"),
    ("country", "country pop", "americana"),
    ("hip hop", "trap", "rap", "gen z"),
    ("rock", "indie rock", "folk", "rock"),
    ("jazz", "latin", "vocal jazz", "big band"),
    (),
    ("r&b", "soul", "pop", "Pop"),
    ("singer-songwriter", "electronic", "trap soul"),
)
HOUSE_TAGS = ("dance-pop", "electropop", "english")


def _tag_array(tags: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(t) for t in tags]).cast("array<string>")


def _act_tags() -> Column:
    brand = F.substring_index("p_brand", "#", -1).cast("int") % 8
    by_brand = F.coalesce(*[F.when(brand == i, _tag_array(t)) for i, t in enumerate(BRAND_TAGS)])
    return F.when(_lead_act() == HOUSE_ACT, _tag_array(HOUSE_TAGS)).otherwise(by_brand)


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and credit of every part."""
    return spark.read.parquet(table_path(sf_dir, "part")).select(
        F.col("p_partkey").alias("song_key"),
        F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("title"),
        _credit().alias("artist"),
    )


def chart_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw chart entries of all weeks: chart_date and the six entry fields.

    A song has one row per week it sold in, so the per-song window is bounded by
    the number of weeks. A song that was away for over ``_AWAY_WEEKS`` debuts again.
    Some songs' documents lack weeks_on_chart or last_pos.
    """
    song = Window.partitionBy("song_key").orderBy("chart_date")
    so_far = song.rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag("chart_date").over(song)
    place = F.row_number().over(song)
    placed = rank_within_week(weekly_volumes(spark, sf_dir)).select(
        "chart_date",
        "song_key",
        "rank",
        place.alias("place"),
        # the place of each debut, the first or one after a long absence
        F.when(before.isNull() | (F.date_diff("chart_date", before) > 7 * _AWAY_WEEKS), place).alias("debut_place"),
        F.min("rank").over(so_far).alias("peak_pos"),
        F.when(before == F.date_sub("chart_date", 7), F.lag("rank").over(song)).otherwise(0).alias("last_pos"),
    )
    weeks = F.col("place") - F.max("debut_place").over(so_far) + 1
    numbered = placed.select(
        "chart_date",
        "song_key",
        "rank",
        F.when(F.col("song_key") % _NO_WEEKS != 0, weeks).alias("weeks_on_chart"),
        "peak_pos",
        F.when(F.col("song_key") % _NO_LAST_POS != 0, F.col("last_pos")).alias("last_pos"),
    )
    return numbered.join(songs(spark, sf_dir), "song_key").select(
        "chart_date", "rank", "title", "artist", "weeks_on_chart", "peak_pos", "last_pos"
    )


def artist_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup answers: every part proposes one candidate for its lead act.

    Some answers carry no score and some lookups failed with an error.
    """
    key = F.col("p_partkey")
    failed = F.col("p_size") >= 45
    score = F.when(key % 7 != 0, (60 + key * 7 % 41).cast("int"))
    return spark.read.parquet(table_path(sf_dir, "part")).select(
        _lead_act().alias("name"),
        F.when(~failed, F.concat(F.lit("id-"), key.cast("string"))).alias("artist_id"),
        F.when(~failed, score).alias("score"),
        F.when(~failed, _act_tags()).alias("tags"),
        F.when(failed, F.lit("lookup timed out")).alias("error"),
    )


def act_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every act once: artist, artist_id (the least of its parts) and tags."""
    acts = spark.read.parquet(table_path(sf_dir, "part")).select(
        _lead_act().alias("artist"), F.col("p_partkey").alias("key"), _act_tags().alias("tags")
    )
    first = acts.groupBy("artist").agg(F.min(F.struct("key", "tags")).alias("first"))
    return first.select("artist", F.concat(F.lit("id-"), F.col("first.key").cast("string")).alias("artist_id"), "first.tags")


def metadata_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artist metadata with repeated credits: one version per part, in key order."""
    key = F.col("p_partkey")
    return spark.read.parquet(table_path(sf_dir, "part")).select(
        _credit().alias("artist"),
        _lead_act().alias("primary_artist_used"),
        F.concat(F.lit("id-"), key.cast("string")).alias("mbid"),
        _act_tags().alias("tags"),
        (F.col("p_size") < 45).alias("found"),
        F.lit(None).cast("string").alias("error"),
        key.alias("version"),
    )


def snapshot_pages(entries: DataFrame, page_size: int = 25) -> DataFrame:
    """Chart entries regrouped into documents of at most ``page_size`` entries."""
    fields = ["rank", "title", "artist", "weeks_on_chart", "peak_pos", "last_pos"]
    page = F.floor((F.col("rank") - 1) / page_size).cast("int")
    return entries.groupBy("chart_date", page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("entries")
    )


def fetched_pages(entries: DataFrame, page_size: int = 25) -> DataFrame:
    """The pages of each week up to the first empty one, which ends its fetch."""
    pages = snapshot_pages(entries, page_size).select("chart_date", "page", "entries")
    nothing = F.array().cast(pages.schema["entries"].dataType).alias("entries")
    last = pages.groupBy("chart_date").agg((F.max("page") + 1).alias("page"))
    return pages.unionByName(last.select("chart_date", "page", nothing))


def refetched_pages(entries: DataFrame, page_size: int = 25) -> DataFrame:
    """Each page fetched twice: first with new and re-entered songs only, then whole."""
    pages = snapshot_pages(entries, page_size)
    first = pages.select(
        "chart_date",
        "page",
        F.filter("entries", lambda e: e.last_pos == 0).alias("entries"),
        F.col("chart_date").alias("ingested_at"),
    )
    second = pages.select("chart_date", "page", "entries", F.date_add("chart_date", 1).alias("ingested_at"))
    return first.unionByName(second)
