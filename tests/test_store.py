import json

from versegrid.operators import rollups, store
from versegrid.sources import texts


def _tables(spark):
    works = spark.createDataFrame([(1, "a.txt", "A", "T", 1500, "u1", None, "txt"), (2, "b.txt", None, None, None, None, "", "thml"), (5, "c.txt", "C", "U", 1600, "u1", "Puritan", "thml")], store.WORKS)
    refs = spark.createDataFrame([(1, "Romans", "romans", 8, 13, 17, 0, 0, 9), (1, "Romans", "romans", 8, None, None, 5, 0, 9), (5, "Jude", "jude", 201, 1, None, 3, 0, 4)], store.REFS)
    return works, refs


def test_migration(spark):
    old = spark.createDataFrame([(1, "a.txt")], "id bigint, filename string")
    assert [tuple(r) for r in store.migrated(old).collect()] == [(1, "a.txt", None, "txt")]
    works, _ = _tables(spark)
    assert store.migrated(works).columns == works.columns


def test_reparse_is_idempotent_and_clears(spark):
    works, refs = _tables(spark)
    mine = refs.where("manuscript_id = 1")
    once = store.replace_references(refs, works.where("id = 1"), mine)
    assert sorted(map(str, once.collect())) == sorted(map(str, refs.collect()))
    assert store.replace_references(refs, works.where("id = 1"), refs.limit(0)).count() == 1


def test_upsert_keeps_ids(spark):
    works, _ = _tables(spark)
    new = works.where("id = 2").drop("id").unionByName(spark.createDataFrame([("x.txt",), ("d.txt",)], "filename string"), allowMissingColumns=True)
    got = {r.filename: r.id for r in store.upsert(works, new).collect()}
    assert got == {"a.txt": 1, "b.txt": 2, "c.txt": 5, "d.txt": 6, "x.txt": 7}


def test_many_new_names_get_their_own_ids(spark):
    works, _ = _tables(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    new = spark.range(200_000).selectExpr("concat('n', lpad(id, 6, '0')) AS filename")
    got = store.upsert(works, works.limit(0).unionByName(new, allowMissingColumns=True)).where("filename LIKE 'n%'")
    told = got.selectExpr("count(id) AS n", "count(DISTINCT id) AS d", "min(id) AS a", "max(id) AS b", "sum(CASE WHEN id = 6 + cast(substr(filename, 2) AS int) THEN 1 ELSE 0 END) AS ordered").first()
    assert tuple(told) == (200_000, 200_000, 6, 200_005, 200_000)


def test_precedence_and_removal(spark):
    works, refs = _tables(spark)
    assert sorted(r.id for r in store.annotated_first(works).collect()) == [2, 5]
    kept, left = store.remove(works, refs, works.where("id = 5").select("id"))
    assert kept.count() == 2 and left.count() == 2


def test_empty_category_stays_empty_and_totals_agree(spark):
    works, refs = _tables(spark)
    counts = {(r.book_slug, r.category): r.n for r in rollups.chapter_category_counts(refs, works).collect()}
    assert counts == {("romans", "Other"): 2, ("jude", "Puritan"): 1}
    assert sum(counts.values()) == sum(r.ref_count for r in rollups.work_counts(refs, works).collect())
    assert rollups.in_canon(rollups.chapter_category_counts(refs, works)).count() == 1


def test_clean_texts_are_written(spark, tmp_path):
    from versegrid.sources import thml

    docs = spark.createDataFrame([("a/b.xml", "<x><p>one &amp; two</p></x>")], "path string, content string")
    texts.write_texts(thml.parse(docs), str(tmp_path / "texts"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "texts")).collect()] == [("a/b.txt", "one & two")]


def test_chapters_are_written_by_book(spark, tmp_path):
    works, refs = _tables(spark)
    texts.write_parquet(rollups.chapter_payloads(refs, works), str(tmp_path / "chapters"), by="book_slug")
    assert {(r.book_slug, r.chapter, len(r.refs)) for r in spark.read.parquet(str(tmp_path / "chapters")).collect()} == {("romans", 8, 2), ("jude", 201, 1)}
    assert {r.book_slug for r in rollups.chapter_payloads(refs, works, only="jude").collect()} == {"jude"}


def test_sinks(spark, tmp_path):
    works, refs = _tables(spark)
    payload = rollups.book_payloads(refs, works)
    rows = {r.book_slug: json.loads(v) for r, v in zip(payload.collect(), [x.value for x in texts.as_json(payload).collect()], strict=True)}
    assert rows["romans"]["chapters"][0]["refs"] == [{"v": "13-17", "w": 1, "p": "a_0_9"}, {"v": None, "w": 1, "p": "a_0_9"}]
    texts.write_parquet(payload, str(tmp_path / "books"), by="book_slug")
    texts.write_parquet(payload, str(tmp_path / "books"), by="book_slug")
    assert spark.read.parquet(str(tmp_path / "books")).count() == 2
