"""The queries that have a SQL twin, and odd tables for the operators behind them."""

import pathlib
import random
import re

import duckdb
import odd
import pyarrow as pa
import pytest
from conftest import SMALL
from oracle import compare, connect

from fleetprep.cluster import shared_folder
from fleetprep.llm import catalogue, licenses, line_dedup, mixing, ngram_join, passage_dedup, quality_rules, scan

RUN, SQL = catalogue.registered()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("label", sorted(SQL))
def test_equals_sql(spark, duck, label):
    assert compare(spark, duck, SMALL, RUN[label], SQL[label]) is None


OPERATORS = {
    "op2_line_dedup": line_dedup.judged,
    "op7_mixing": lambda d: mixing.mix(d).select("doc_id", "size", "source_size", "target", "taken"),
    "op8_licenses": licenses.scan_licenses,
    "op10_quality_rules": quality_rules.judge,
}


def odd_duck(rows):
    import pandas as pd

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"})  # noqa: F841
    con.execute("INSERT INTO documents SELECT * FROM frame")
    return con


@pytest.mark.parametrize("label", sorted(OPERATORS))
def test_odd_rows_equal_sql(spark, label):
    """Nulls, empty and long texts, clashing columns; ids that are missing or repeated are beyond the SQL twins, which join on them."""
    once = {r[0]: r for r in odd.ROWS if r[0] is not None}
    rows = list(once.values())
    got = compare(spark, odd_duck(rows), "", lambda s, _: OPERATORS[label](odd.documents(s, rows, more=True)), SQL[label])
    assert got is None


@pytest.mark.parametrize("label", sorted(OPERATORS))
def test_missing_and_repeated_ids(spark, label):
    rows = OPERATORS[label](odd.documents(spark)).collect()
    if label == "op2_line_dedup":
        gone = {(r["doc_id"], r["unit"], r["kept_doc_id"]) for r in rows if not r["kept"]}
        assert gone == {(2, 0, 1), (8, 0, 7), (10, 1, 10), (10, 2, 10), (12, 1, 12), (12, 2, 12), (12, 3, 12)}
        nameless = [(None, f"x y\n{odd.SAME}", "en", "s", 0)] * 2 + [(None, "x  Y\nx y", "en", "s", 0)]
        rows = OPERATORS[label](odd.documents(spark, nameless)).collect()
        assert sum(r["kept"] for r in rows) == 2 and len(rows) == 6 and {(r["copies"], r["kept_doc_id"]) for r in rows} == {(4, None), (2, None)}
    else:
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in odd.ROWS)
        twins = [tuple(r) for r in rows if r["doc_id"] == 2]
        if label != "op7_mixing":  # copies of one document may be taken differently often
            assert twins[0] == twins[1]


@pytest.mark.parametrize("label", sorted(OPERATORS))
def test_empty_table(spark, label):
    assert OPERATORS[label](odd.documents(spark, [])).collect() == []


def test_cleaned_text(spark):
    docs = odd.documents(spark, [(1, f"a\n{odd.SAME}\nb", "en", "s", 0), (2, f"{odd.SAME.upper()}\nc\n{odd.SAME}", "en", "s", 0), (3, None, "en", "s", 0)], more=True)
    out = {r["doc_id"]: r for r in line_dedup.cleaned(docs, line_dedup.removals(docs)).collect()}
    assert out[1]["text"] == f"a\n{odd.SAME}\nb" and out[1]["spans"] is None and out[3]["text"] is None
    n = len(odd.SAME)
    assert out[2]["text"] == "c\n" and [tuple(s) for s in out[2]["spans"]] == [(0, n), (n + 3, 2 * n + 3)]


def test_paragraphs(spark):
    two = f"{odd.prose(9, 1)}\n{odd.prose(9, 2)}"
    docs = odd.documents(spark, [(1, f"{two}\n\nx", "en", "s", 0), (2, f"y\n\n{two}", "en", "s", 0)])
    assert [(r["doc_id"], r["start"], r["stop"]) for r in line_dedup.removals(docs, "paragraph").collect()] == [(2, 3, 3 + len(two))]


def test_mix_meets_targets(spark):
    rows = mixing.mix(spark.read.parquet(f"{SMALL}/documents.parquet")).toPandas()
    assert (rows["copies"] <= 2).all() and (rows["copies"] >= 0).all()
    for _, g in rows.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 2 * g["size"].max()
    again = mixing.mix(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(7)).toPandas()
    key = ["doc_id", "copies"]
    assert rows[key].sort_values("doc_id").values.tolist() == again[key].sort_values("doc_id").values.tolist()


def test_bad_host_goes(spark):
    good = [(k, odd.prose(30, k), "en", f"host{k % 4}", 0) for k in range(40)]
    bad = [(100 + k, "spam " * 50, "en", "worst", 0) for k in range(9)] + [(200, odd.prose(30, 300), "en", "worst", 0)]
    out = {r["doc_id"]: r for r in quality_rules.judge(odd.documents(spark, good + bad)).collect()}
    assert all(out[k]["kept"] for k in range(40))
    assert not out[200]["base_failed"] and not out[200]["kept"]


def test_license_templates(spark):
    texts = ["Permission is hereby GRANTED, free of charge, to any person obtaining a copy of this software and its associated documentation", "all rights reversed", "rights: reserved, all", "Released under the BSD License."]
    out = [r["labels"] for r in licenses.scan_licenses(odd.documents(spark, [(k, t, "en", "s", 0) for k, t in enumerate(texts)])).orderBy("doc_id").collect()]
    assert out == ["mit", "", "all-rights-reserved", "mit"]


def test_short_lines_go(spark):
    rows = [(1, "All rights reserved.\n\nx y", "en", "s", 0), (2, f"{odd.prose(20, 1)}\nALL  rights reserved.", "en", "s", 0), (3, "x\n \nx y\nx", "en", "s", 0)]
    assert line_dedup.removals(odd.documents(spark, rows), min_words=4).count() == 0
    out = line_dedup.removals(odd.documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["unit"], r["n_words"], r["kept_doc_id"], r["kept_unit"]) for r in out) == [(2, 1, 3, 1, 0), (3, 2, 2, 1, 1), (3, 3, 1, 3, 0)]
    assert RUN["op2_every_line_dedup"](spark, SMALL).where("n_words < 8").count() > 0


def test_moved_words_are_other_windows(spark):
    """x y y x and y x x y: windows of the same words at places of equal sums."""
    rows = [(1, "x y y x z y x x y z", "en", "s", 0), (2, "x y y x z x y y x z", "en", "s", 0)]
    got = compare(spark, odd_duck(rows), "", lambda s, _: quality_rules.judge(odd.documents(s, rows)), SQL["op10_quality_rules"])
    assert got is None
    assert len(ngram_join.shingle_sets(next(scan.slices(pa.array([rows[0][1]])))[2])[0]) == 6
    words = odd.prose(46, 1)
    rows = [(1, f"x y y x {words}", "en", "s", 0), (2, f"y x x y {words}", "en", "s", 0)]
    assert passage_dedup.removals(odd.documents(spark, rows)).count() == 0


def test_passage_across_lines(spark):
    shared = odd.prose(54, 5).split()
    lines = lambda k: "\n".join(" ".join(shared[i : i + k]) for i in range(0, 54, k))
    one, two = f"é {odd.prose(9, 1)} {lines(11)} {odd.prose(5, 2)}", f"é {odd.prose(4, 3)} {lines(7).upper()} {odd.prose(20, 4)}"
    docs = odd.documents(spark, [(1, one, "en", "s", 0), (2, two, "en", "s", 0), (3, " ".join(shared[:49]), "en", "s", 0)], more=True)
    start = two.index(shared[0].upper() + " " + shared[1].upper())
    assert [tuple(r) for r in passage_dedup.removals(docs).collect()] == [(2, start, start + len(lines(7)), 54)]
    assert line_dedup.removals(docs).count() == 0


def test_passage_odd_rows_equal_sql(spark):
    rows = list({r[0]: r for r in odd.ROWS if r[0] is not None}.values()) + [(20, "a b " * 60, "en", "s", 0), (21, "\n c " + "a b " * 60, "en", "s", 0)]
    assert compare(spark, odd_duck(rows), "", lambda s, _: passage_dedup.removals(odd.documents(s, rows, more=True)), SQL["op2_passage_dedup"]) is None
    assert passage_dedup.removals(odd.documents(spark, [])).collect() == []
    assert {r["doc_id"] for r in passage_dedup.removals(odd.documents(spark)).collect()} == {2, 12}  # NEAR shares 30 words on either side


def passages(rows, width):
    """Plain search: the runs of words in a later copy of a window and in no first copy."""
    texts = {d: [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\S+", t)] for d, t in rows}
    found = {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - width + 1):
            found.setdefault(tuple(w for *_, w in texts[d][i : i + width]), []).append((d, i))
    later, firsts = set(), set()
    for first, *rest in found.values():
        later |= {(d, i + k) for d, i in rest for k in range(width)}
        firsts |= {(first[0], first[1] + k) for k in range(width) if rest}
    goes, out = later - firsts, []
    for d, i in sorted(goes):
        out = [*out[:-1], (d, out[-1][1], texts[d][i][1], out[-1][3] + 1)] if (d, i - 1) in goes else [*out, (d, *texts[d][i][:2], 1)]
    return out


@pytest.mark.parametrize("width", [3, 8, 21, 50])
def test_passages_equal_plain_search(spark, width):
    """Edited copies, passages at several places, short vocabularies with many ties, and copies of copies."""
    r = random.Random(width)
    rows = [(k, " ".join(r.choice("ab") for _ in range(r.randint(0, 90)))) for k in range(6)]
    base = odd.prose(400, 1).split()
    for k in range(10, 50):
        lo = r.randint(0, 330)
        words = base[lo : lo + r.randint(1, 180)]
        for _ in range(r.choice([0, 0, 1, 3])):
            words[r.randrange(len(words))] = r.choice(["x", "y"])
        rows.append((k, "\n".join([odd.prose(r.randint(0, 20), k % 5), " ".join(words), odd.prose(r.randint(0, 9), 100 + k)])))
    rows += [(k + 100, t.upper()) for k, t in rows if k % 3 == 0]
    docs = odd.documents(spark, [(k, t, "en", "s", 0) for k, t in rows]).repartition(3)
    assert sorted(tuple(x) for x in passage_dedup.removals(docs, width).collect()) == passages(rows, width) != []


def test_passage_of_a_document_given_twice(spark):
    """A repeated row is no copy of its windows: it protects no words of the passage that goes."""
    shared = odd.prose(80, 5)
    rows = [(1, shared, "en", "s", 0), (2, f"{odd.prose(60, 6)} {shared} {odd.prose(60, 7)}", "en", "s", 0)]
    once = [tuple(x) for x in passage_dedup.removals(odd.documents(spark, rows)).collect()]
    assert [x[3] for x in once] == [80]
    assert [tuple(x) for x in passage_dedup.removals(odd.documents(spark, [*rows, rows[1]])).collect()] == once * 2


def test_passages_stage_less_than_the_texts(spark):
    """Equal blocks are settled as blocks; windows are only compared where copies part."""
    rows = [(k, f"{odd.prose(30, 100 + k)} {odd.prose(3000, k % 4)}", "en", "s", 0) for k in range(40)]
    files = lambda: {p: p.stat().st_size for p in pathlib.Path(shared_folder(spark)).rglob("*.parquet")}
    before = files()
    assert passage_dedup.removals(odd.documents(spark, rows)).count() == 36
    staged = sum(n for p, n in files().items() if p not in before)
    assert 0 < staged < sum(len(x[1]) for x in rows)


@pytest.mark.parametrize("width", [3, 8, 13, 40])
def test_wrapped_notices(spark, width):
    notices = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    }
    rows = []
    for k, text in enumerate(notices.values()):
        words = f"{odd.prose(45, k)} {text} {odd.prose(45, 10 + k)}".split()
        rows.append((k, "\n * \n".join(" * " + " ".join(words[i : i + width]) for i in range(0, len(words), width)), "en", "s", 0))
    found = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(odd.documents(spark, rows), phrases={"cc by": "cc-by"}).collect()}
    assert [found[k] for k in range(4)] == list(notices)


def test_words_near_a_wrapped_notice_are_not_its_words(spark):
    texts = ["kam mit der\nLicensed under the Apache License, version 2.0", "released\n\nunder the\nMIT license", "all\nthe rights\nreserved"]
    out = licenses.scan_licenses(odd.documents(spark, [(k, t, "en", "s", 0) for k, t in enumerate(texts)]), phrases={"cc by": "cc-by"}).orderBy("doc_id")
    assert [r["labels"] for r in out.collect()] == ["apache", "mit", ""]
