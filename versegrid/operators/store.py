"""Updates of the works and references tables, as new DataFrames to write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.storage import cut

WORKS = "id bigint, filename string, author string, title string, year int, ccel_url string, category string, source_format string"
REFS = "manuscript_id bigint, book string, book_slug string, chapter int, verse_start int, verse_end int, citation_offset int, passage_start_offset int, passage_end_offset int"


def migrated(works: DataFrame) -> DataFrame:
    """Works of an older layout with the columns that came later."""
    for name, default in (("category", F.lit(None).cast("string")), ("source_format", F.lit("txt"))):
        works = works.withColumn(name, F.coalesce(name, default)) if name in works.columns else works.withColumn(name, default)
    return works


def upsert(works: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` replace those of the same filename and keep their id; others get ids beyond the largest.

    New ids follow the order of filenames. The category of a re-parsed text is
    reset, which is why classification runs afterwards.
    """
    top = works.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    known = works.select("filename", F.col("id").alias("old_id"))
    fresh = new.drop("id").join(known, "filename", "left")
    named = fresh.where("old_id is null").select("filename").distinct()
    # Positions come from counts by range partition, not from one sorted partition. Names are stored with their partition
    # and place once: another plan could be cut into other partitions.
    placed = named.repartitionByRange("filename").sortWithinPartitions("filename").select("filename", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"))
    ranged = cut(placed)
    # One row a partition, so these are few whatever the number of names.
    sizes = ranged.groupBy("p").agg(F.count("*").alias("n"), F.min("m").alias("first"))
    before = sizes.select("p", "first", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("skip"))
    numbered = ranged.join(F.broadcast(before), "p").crossJoin(F.broadcast(top)).select("filename", (F.col("top") + F.col("skip") + F.col("m") - F.col("first") + 1).alias("new_id"))
    replaced = fresh.join(numbered, "filename", "left").withColumn("id", F.coalesce("old_id", "new_id")).select(*works.columns)
    return works.join(new.select("filename"), "filename", "left_anti").select(*works.columns).unionByName(replaced)


def replace_references(refs: DataFrame, parsed_ids: DataFrame, new: DataFrame) -> DataFrame:
    """References after re-parsing works: theirs go, also where the new parse finds none, and the new ones come."""
    return refs.join(parsed_ids.select(F.col("id").alias("manuscript_id")), "manuscript_id", "left_anti").select(*refs.columns).unionByName(new.select(*refs.columns))


def remove(works: DataFrame, refs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Works and references without the works of some ids."""
    return works.join(ids.select("id"), "id", "left_anti"), refs.join(ids.select(F.col("id").alias("manuscript_id")), "manuscript_id", "left_anti")


def clean(works: DataFrame, refs: DataFrame, delete: list[str], purge: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(works, refs, archived): delete works, purge the references of others, then archive works without references."""
    gone = works.where(F.col("filename").isin(delete))
    kept, left = remove(works, refs, gone)
    left = left.join(kept.where(F.col("filename").isin(purge)).select(F.col("id").alias("manuscript_id")), "manuscript_id", "left_anti")
    archived = kept.join(left.select(F.col("manuscript_id").alias("id")), "id", "left_anti")
    return kept.join(archived.select("id"), "id", "left_anti"), left, archived


def annotated_first(works: DataFrame) -> DataFrame:
    """Text works whose address an annotated work has go; works without an address stay."""
    thml = works.where("source_format = 'thml'").select("ccel_url")
    return works.where("source_format = 'thml'").unionByName(works.where("source_format <> 'thml'").join(thml, "ccel_url", "left_anti").select(*works.columns))


# Years that beat those of the texts, by filename.
YEARS = """
manuscripts/ccel_thml/philo/works.txt 40
manuscripts/ccel_thml/irenaeus/demonstr.txt 180
manuscripts/ccel_thml/origen/prayer.txt 233
manuscripts/ccel_thml/athanasius/incarnation.txt 318
manuscripts/ccel_thml/augustine/confess.txt 397
manuscripts/ccel_thml/augustine/confessions.txt 397
manuscripts/ccel_thml/augustine/doctrine.txt 397
manuscripts/ccel_thml/augustine/enchiridion.txt 421
manuscripts/ccel_thml/athanasius/paradise1.txt 420
manuscripts/ccel_thml/athanasius/paradise2.txt 420
manuscripts/ccel_thml/cassian/conferences.txt 420
manuscripts/ccel_thml/dionysius/celestial.txt 500
manuscripts/ccel_thml/dionysius/works.txt 500
manuscripts/ccel_thml/gregory/life_rule.txt 593
manuscripts/ccel_thml/schaff/anf01.txt 96
manuscripts/ccel_thml/schaff/anf02.txt 150
manuscripts/ccel_thml/schaff/anf03.txt 200
manuscripts/ccel_thml/schaff/anf04.txt 230
manuscripts/ccel_thml/schaff/anf05.txt 250
manuscripts/ccel_thml/schaff/anf06.txt 250
manuscripts/ccel_thml/schaff/anf07.txt 305
manuscripts/ccel_thml/schaff/anf08.txt 300
manuscripts/ccel_thml/schaff/anf09.txt 226
manuscripts/ccel_thml/schaff/anf10.txt 1896
manuscripts/ccel_thml/schaff/npnf101.txt 397
manuscripts/ccel_thml/schaff/npnf102.txt 413
manuscripts/ccel_thml/schaff/npnf103.txt 400
manuscripts/ccel_thml/schaff/npnf104.txt 388
manuscripts/ccel_thml/schaff/npnf105.txt 412
manuscripts/ccel_thml/schaff/npnf106.txt 393
manuscripts/ccel_thml/schaff/npnf107.txt 407
manuscripts/ccel_thml/schaff/npnf108.txt 392
manuscripts/ccel_thml/schaff/npnf109.txt 386
manuscripts/ccel_thml/schaff/npnf110.txt 390
manuscripts/ccel_thml/schaff/npnf111.txt 391
manuscripts/ccel_thml/schaff/npnf112.txt 392
manuscripts/ccel_thml/schaff/npnf113.txt 394
manuscripts/ccel_thml/schaff/npnf114.txt 391
manuscripts/ccel_thml/schaff/npnf201.txt 313
manuscripts/ccel_thml/schaff/npnf202.txt 448
manuscripts/ccel_thml/schaff/npnf203.txt 395
manuscripts/ccel_thml/schaff/npnf204.txt 318
manuscripts/ccel_thml/schaff/npnf205.txt 380
manuscripts/ccel_thml/schaff/npnf206.txt 393
manuscripts/ccel_thml/schaff/npnf207.txt 350
manuscripts/ccel_thml/schaff/npnf208.txt 370
manuscripts/ccel_thml/schaff/npnf209.txt 350
manuscripts/ccel_thml/schaff/npnf210.txt 374
manuscripts/ccel_thml/schaff/npnf211.txt 400
manuscripts/ccel_thml/schaff/npnf212.txt 445
manuscripts/ccel_thml/schaff/npnf213.txt 350
manuscripts/ccel_thml/schaff/npnf214.txt 325
manuscripts/ccel_thml/bernard/loving_god.txt 1132
manuscripts/ccel_thml/bernard/letters.txt 1130
manuscripts/ccel_thml/bernard/st_malachy.txt 1149
bernard_st_malachy.txt 1149
manuscripts/ccel_thml/anselm/basic_works.txt 1078
manuscripts/ccel_thml/anselm/meditations.txt 1100
manuscripts/ccel_thml/anselm/devotions.txt 1100
manuscripts/ccel_thml/aquinas/gentiles.txt 1258
manuscripts/ccel_thml/aquinas/catena1.txt 1263
manuscripts/ccel_thml/aquinas/catena2.txt 1263
manuscripts/ccel_thml/aquinas/nature_grace.txt 1260
manuscripts/ccel_thml/aquinas/summa.txt 1265
manuscripts/ccel_thml/bonaventure/mindsroad.txt 1259
manuscripts/ccel_thml/rolle/fire.txt 1343
manuscripts/ccel_thml/tauler/inner_way.txt 1340
manuscripts/ccel_thml/tauler/following.txt 1350
manuscripts/ccel_thml/tauler/meditations.txt 1350
manuscripts/ccel_thml/eckhart/sermons.txt 1305
manuscripts/ccel_thml/eckhart/mystische.txt 1305
manuscripts/ccel_thml/pfeiffer/eckhart1.txt 1305
manuscripts/ccel_thml/anonymous2/cloud.txt 1375
manuscripts/ccel_thml/hilton/ladder.txt 1388
manuscripts/ccel_thml/hilton/angels.txt 1388
manuscripts/ccel_thml/hilton/treatise.txt 1390
manuscripts/ccel_thml/kempis/imitation.txt 1418
manuscripts/ccel_thml/kempis/founders.txt 1425
manuscripts/ccel_thml/ignatius/exercises.txt 1548
manuscripts/ccel_thml/ignatius/autobiography.txt 1555
manuscripts/ccel_thml/guyon/spiritual_torrents.txt 1682
guyon_spiritual_torrents.txt 1682
manuscripts/ccel_thml/guyon/prayer.txt 1685
manuscripts/ccel_thml/guyon/auto.txt 1688
manuscripts/ccel_thml/guyon/song.txt 1688
manuscripts/ccel_thml/fenelon/maxims.txt 1697
manuscripts/ccel_thml/fenelon/existence_god.txt 1712
fenelon_existence_god.txt 1712
manuscripts/ccel_thml/fenelon/progress.txt 1877
manuscripts/ccel_thml/lawrence/practice.txt 1692
manuscripts/ccel_thml/baker/more.txt 1657
manuscripts/ccel_thml/law/apracticaltreat.txt 1726
law_apracticaltreat.txt 1726
manuscripts/ccel_thml/law/serious_call.txt 1729
manuscripts/ccel_thml/law/humbleearnest.txt 1761
law_humbleearnest.txt 1761
manuscripts/ccel_thml/law/love2.txt 1752
manuscripts/ccel_thml/law/prayer.txt 1749
manuscripts/ccel_thml/law/collection.txt 1760
manuscripts/ccel_thml/law/errors.txt 1740
manuscripts/ccel_thml/law/doubt.txt 1740
manuscripts/ccel_thml/law/clergy.txt 1761
manuscripts/ccel_thml/law/grounds.txt 1739
manuscripts/ccel_thml/law/waytodivine.txt 1752
manuscripts/ccel_thml/feltoe/dionysius.txt 1904
manuscripts/ccel_thml/richardson/fathers.txt 1953
manuscripts/ccel_thml/potts/prayerearly.txt 1953
manuscripts/ccel_thml/leightonpullan/earlychristian.txt 1898
manuscripts/ccel_thml/lightfoot/fathers.txt 1891
manuscripts/ccel_thml/lake/fathers2.txt 1912
manuscripts/ccel_thml/brownlie/earlyhymns.txt 1907
manuscripts/ccel_thml/brownlie/latinhymns.txt 1907
manuscripts/ccel_thml/deane/pseudepig.txt 1891
manuscripts/ccel_thml/tolstoy/gospel.txt 1896
manuscripts/ccel_thml/bacon_lw/history.txt 1897
manuscripts/ccel_thml/scrivener/ntcrit1.txt 1883
manuscripts/ccel_thml/scrivener/ntcrit2.txt 1883
manuscripts/ccel_thml/farrar/clouds.txt 1895
manuscripts/ccel_thml/manning/wesleyhymns.txt 1942
"""


def known_years(spark: SparkSession) -> DataFrame:
    """(filename, year) of the works whose year is known better than their texts tell it."""
    rows = [line.rsplit(" ", 1) for line in YEARS.strip().split("\n")]
    return spark.createDataFrame([(name, int(year)) for name, year in rows], "filename string, year int")


def update_years(works: DataFrame, years: DataFrame) -> DataFrame:
    """Works with the years of (filename, year) rows where there is one."""
    y = years.select("filename", F.col("year").alias("new_year"))
    return works.join(y, "filename", "left").withColumn("year", F.coalesce("new_year", "year")).select(*works.columns)


def unmatched_years(works: DataFrame, years: DataFrame) -> DataFrame:
    return years.join(works.select("filename"), "filename", "left_anti").select("filename")


def year_tally(works: DataFrame, years: DataFrame) -> DataFrame:
    """How many keys of ``years`` there are works for."""
    known = works.select("filename").distinct().withColumn("known", F.lit(1))
    return years.join(known, "filename", "left").agg(F.count("known").alias("updated"), F.count(F.when(F.col("known").isNull(), 1)).alias("not_found"))


def patches(outputs: DataFrame, works: DataFrame) -> DataFrame:
    """(id, old_year, new_year) of built outputs whose year the table contradicts; a null year patches nothing."""
    w = works.where("year is not null").select("id", F.col("year").alias("new_year"))
    return outputs.select("id", F.col("year").alias("old_year")).join(w, "id").where(~F.col("old_year").eqNullSafe(F.col("new_year")))
