"""Catalogue queries take whole tables."""

import os

import pytest

from versegrid.plans import catalog
from versegrid.plans.synth import Views

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def test_whole_texts_are_escaped(spark):
    got = {r.doc_id: r.escaped for r in catalog.QUERIES["text_escaped"](spark, DATA).collect()}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        assert got[r.doc_id] == (r.text or "").replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
    assert max(map(len, got.values())) > 1000


def test_previews_keep_their_escaped_texts(spark):
    got = {r.doc_id: r.escaped for r in catalog.QUERIES["text_previews"](spark, DATA).collect()}
    want = {r.doc_id: r.escaped for r in catalog.QUERIES["text_escaped"](spark, DATA).collect()}
    assert got == want and "AS escaped" in catalog.ORACLES["text_previews"] and "left(text, 200)" not in catalog.ORACLES["text_previews"]


def test_all_works_meet_their_verses(spark):
    got = catalog.QUERIES["verse_text_join_all"](spark, DATA)
    assert got.count() == Views(spark, DATA).refs.count() > catalog.QUERIES["verse_text_join"](spark, DATA).count()
    assert 0 < got.where("verse_text is null").count() < got.count()


def test_all_citations_are_placed_and_no_document_is_lost(spark, tmp_path):
    v = Views(spark, DATA)
    whole = "\n".join(r.text or "" for r in catalog._passage_works(v).collect())
    said = {r.text for r in v.citation_texts.select("text").collect()}
    assert len(said) > 1000 and all(t in whole for t in said)
    for f in os.listdir(DATA):
        if f != "lineitem.parquet":
            os.symlink(f"{DATA}/{f}", tmp_path / f)
    spark.read.parquet(f"{DATA}/lineitem.parquet").where("l_orderkey < 8").write.parquet(str(tmp_path / "lineitem.parquet"))
    few, docs = catalog._passage_works(Views(spark, str(tmp_path))), spark.read.parquet(f"{DATA}/documents.parquet")
    assert sorted(r.id for r in few.collect()) == sorted(r.doc_id for r in docs.collect())
