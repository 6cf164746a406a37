from versegrid.functions.registry import register
from versegrid.operators import citations


def test_functions_from_sql(spark):
    register(spark)
    text = "It's \U0001f600 (Rom. viii. 13, 15) and St. John 3:16; ed 4. Gen. 99. 1, no"
    spark.createDataFrame([(1, text), (2, None)], "id int, body string").createOrReplaceTempView("bodies")
    got = spark.sql("SELECT c.* FROM bodies, LATERAL extract_citations(body) c").collect()
    want = citations.extract(spark.table("bodies"), text="body").drop("id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 2
    assert spark.sql("SELECT highlight_passage('Before it. He said (Rom. viii. 13) so. After <it>.', 8, '13') AS m").first().m == "Before it. <mark>He said (Rom. viii. 13) so.</mark> After &lt;it&gt;."
    walked = spark.sql("""SELECT w.clean_text, w.hits[0].citation_offset AS at, w.title FROM (SELECT thml_walk('<a><DC.Title>T</DC.Title><p>x <scripRef parsed="|Romans|8|1|0|0">y</scripRef></p></a>') AS w)""").first()
    assert tuple(walked) == ("Tx y", 3, "T")
