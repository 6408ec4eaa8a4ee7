"""Single texts that are hard to search: nested, cut off, repetitive, very long."""

from __future__ import annotations

import collections
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import html_extract, mixing, near_dedup, pii, quality_rules, toxicity

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PROSE = "Some plain words of a text that goes on for a while and then ends here."


def extract(page):
    return html_extract.extract(page, html_extract.PLAIN)


@pytest.mark.parametrize("page, wanted", [
    ("<div class='ad'>" * 1_200 + PROSE + "</div>" * 1_200, ""),  # no weight is left for it
    ("<div class='ad'>" * 40 + PROSE + "</div>" * 40, PROSE),
    ("<div class='has-ad'>" * 30 + PROSE + "</div>" * 30, PROSE),
    ("<div class='has-ad'><div class=ad>" * 1_000 + "</div></div>" * 1_000 + PROSE, PROSE),
    ("<p>" + PROSE + "</p>" + "<a " * 350_000, None),
    ("<p>" + PROSE + "</p>" + '<a "' * 250_000 + ">", None),
    ("<p>" + PROSE + "</p><script>" + "</script " * 100_000, PROSE),
    ("<p>" + PROSE + "</p>" + "<!" * 300_000, None),
    ("<article><p>one two</p></article>" * 3_000, "one two"),
    ("<p class=ad>" * 20_000 + PROSE, None),
])
def test_pages_take_no_time(page, wanted):
    began = time.time()
    found = extract(page)
    assert time.time() - began < 3
    assert found == wanted if wanted is not None else PROSE in found


def test_lists_at_the_end_of_a_page_stay(spark):
    weights = html_extract.learned_weights(spark.read.parquet(f"{TINY}/pages.parquet"))
    items = [f"Item {k} with a few words" for k in range(6)]
    page = (f"<body><ul class='menu'><li>Home</li><li>About</li></ul><div><p>{PROSE} {PROSE}</p><ul>"
            + "".join(f"<li>{item}</li>" for item in items) + "</ul></div></body>")
    assert html_extract.extract(page, weights) == "\n\n".join([f"{PROSE} {PROSE}", *items])


def test_pages_keep_columns_named_like_its_own(spark):
    pages = spark.createDataFrame([(1, "<p>a b</p>", "x")], "page_id int, html string, __text string")
    row = html_extract.extracted(pages, html_extract.PLAIN).first()
    assert row["__text"] == "x" and row["text"] == "a b"


@pytest.mark.parametrize("text, kinds", [
    ("x" * 1_000_000 + "@", []), ("x" + "a." * 300_000 + "@example", []), ("@" * 300_000 + "a", []),
    ("ab@" * 200_000, []), ("user@" + "a." * 300_000 + "1", []), ("mail a@" + "b-." * 100_000 + "com now", ["email"]),
    ("-----BEGIN PRIVATE KEY-----" * 20_000, []), ("key" + " " * 500_000 + "x", []),
    (" ".join(f"user{k}@mail{k}.example.com" for k in range(10_000)), ["email"] * 10_000),
    ("Mr. John Smith. " * 5_000 + "Smith, John. " * 5_000, ["given_m", "family"] * 5_000 + ["family", "given_m"] * 5_000),
    ("+1 " * 200_000, []), ("sk-" * 200_000, None), ("1 " * 300_000, []),
])
def test_searching_takes_no_time(text, kinds):
    began = time.time()
    found = pii.find(text)
    assert time.time() - began < 3
    assert kinds is None or [x[2] for x in found] == kinds


def test_names_that_stand_alone_change_alike():
    new, found = pii.replaced("Mr. John Smith came. Smith said so. John agreed, Johnson did not.", {})
    given, family = (pii.surrogate(*x).capitalize() for x in (("given_m", "john"), ("family", "smith")))
    assert new == f"Mr. {given} {family} came. {family} said so. {given} agreed, Johnson did not."


def test_surrogates_over_a_whole_table(spark):
    """Format, distinctness and coreference of all entities of a table, taken from what comes out."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    made, texts = {}, {r.doc_id: r.text for r in docs.collect()}
    rows = pii.with_surrogates(docs, b"another key").collect()
    for r in rows:
        entities, rest, at = pii.find(texts[r.doc_id]), r.text or "", 0
        assert r.n_entities == len(entities)
        for k, (start, end, kind, canon) in enumerate(entities):
            before = texts[r.doc_id][at:start]
            assert rest.startswith(before)
            rest, at = rest[len(before):], end
            following = texts[r.doc_id][end:entities[k + 1][0] if k + 1 < len(entities) else None]
            cut = rest.index(following) if following else len(rest)
            new = rest[:cut]
            rest = rest[cut:]
            made.setdefault((kind, canon), set()).add(pii._plain(kind, new))
            if kind in ("card", "ssn", "phone"):
                shape = ["#" if c.isdigit() else c for c in texts[r.doc_id][start:end]]
                assert shape == ["#" if c.isdigit() else c for c in new][:len(shape)]
        if not entities:
            assert r.text == texts[r.doc_id]
    assert len(made) > 20 and all(len(new) == 1 for new in made.values())  # coreference
    new = collections.Counter((kind.split("_")[0], *names) for (kind, _), names in made.items())
    assert max(new.values()) == 1  # distinctness
    assert not {(kind, canon) for kind, canon in made} & {(kind, *names) for (kind, _), names in made.items()}


def test_private_keeps_columns_of_any_name(spark):
    row = ("a", "Write to anna@mail.example.com", "1", "2", 3)
    docs = spark.createDataFrame([row], "doc_id string, text string, __id string, new string, row int")
    kept = pii.private(docs, pii.EXAMPLE_KEY)
    assert kept.columns == docs.columns
    assert kept.first()[0] == "a" and kept.first()[2:] == ("1", "2", 3) and "anna" not in kept.first()["text"]


def test_ids_may_be_texts(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    labels = spark.read.parquet(f"{TINY}/labels.parquet").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert near_dedup.near_duplicates(docs).where("component_id LIKE 'd%'").count() == docs.count()
    assert near_dedup.one_of_each(docs).count() <= docs.count()
    assert quality_rules.good_documents(docs, labels).count() <= docs.count()
    assert toxicity.scored(docs, toxicity.fitted(docs, labels)).where("score BETWEEN 0 AND 1").count() == docs.count()
    assert mixing.mix(docs.withColumn("source", F.lit("s"))).count() > 0


def test_kinds_of_toxic_texts_come_from_the_texts():
    x = np.array([[1, 1, 0], [1, 1, 0], [1, 0, 1], [1, 0, 0], [1, 0, 0], [0, 0, 0]], float)
    labels = toxicity.kinds_of_toxic(x, np.array([1, 1, 1, 0, 0, 1.0]))
    assert labels[:, 0].tolist() == [1, 1, 0, 0, 0, 0] and labels[:, 1].tolist() == [0, 0, 1, 0, 0, 0]
    assert labels[:, 2].tolist() == [1, 1, 1, 0, 0, 1]
    assert toxicity.kinds_of_toxic(np.zeros((2, 0)), np.zeros(2)).shape == (2, 3)
    empty = toxicity.Chain({})
    empty.fit(empty.matrix([(0, [])]), np.zeros((1, 3)), np.zeros(1, int))
    assert len(empty.score(empty.matrix([(5, [])]))) == 1
