"""Licence scans: equivalent spellings match, other texts do not."""

from pyspark.sql import functions as F

from importlens.llm import license_scan as ls
from importlens.llm.licence_texts import TEXTS

SCHEMA = "doc_id long, text string, license_id string, scope string"


def variants(text):
    return [text, text.upper(), "  " + text.replace(",", " ;") + "!!", "Copyright (c) 2019 Some One\n" + text,
            "(c) 2020 X\n" + text + "\nAll rights reserved."]


def test_variants_match_and_changes_do_not(spark):
    rows, want = [], set()
    for name, texts in TEXTS.items():
        for v in variants(texts[0]):
            want.add((len(rows), name))
            rows.append((len(rows), v, "x", "y"))
    changed = len(rows)
    rows += [(len(rows) + i, t[0] + " unless it rains", "x", "y") for i, t in enumerate(TEXTS.values())]
    got = ls.license_matches(spark.createDataFrame(rows, SCHEMA), ls.known_licenses(spark)).where("scope = 'text'").collect()
    assert want <= {(r.doc_id, r.license_id) for r in got}
    assert not [r for r in got if r.doc_id >= changed]


def test_lines_and_defined_results(spark):
    known = spark.createDataFrame([("k", "Licensed under the K licence."), ("e", ""), ("n", None)], "license_id string, text string")
    rows = [(1, "intro\nlicensed under the K LICENSE\nend"), (1, "intro\nlicensed under the K LICENSE\nend"), (2, None), (3, ""),
            (4, "\n\n..."), (None, "Licensed under the K-licence"), (5, "x " * 500_000 + "\nLicensed under the K licence\n")]
    got = ls.license_matches(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA), known).collect()
    assert {tuple(r) for r in got} == {(1, "k", "line", 2), (None, "k", "text", 1), (5, "k", "line", 1)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ls.license_matches(none, ls.known_licenses(spark)).collect() == []
    docs = spark.createDataFrame([(1, "a", "x", "y")], SCHEMA)
    assert ls.license_matches(docs, none.select("license_id", "text")).collect() == []


def test_whole_texts_of_long_licences_match(spark):
    from pathlib import Path
    folder = Path(ls.__file__).parent / "licences"
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
             "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    texts = {i: (folder / f"{f}.txt").read_text() for f, i in files.items()}
    rows = [(n, v, "x", "y") for n, t in enumerate(texts.values()) for v in (t, "Copyright (c) 2019 Some One\n" + t.upper())]
    cut = texts["Apache-2.0"].index("APPENDIX: How")
    rows += [(50, texts["Apache-2.0"][:cut], "x", "y"), (51, texts["GPL-3.0"][:20000], "x", "y"),
             (52, texts["MPL-2.0"] + " unless it rains", "x", "y")]
    got = ls.license_matches(spark.createDataFrame(rows, SCHEMA), ls.known_licenses(spark)).where("scope = 'text'").collect()
    assert {(r.doc_id, r.license_id, r.matches) for r in got} == {(n, i, 2) for n, i in enumerate(texts)} | {(50, "Apache-2.0", 1)}


def test_searches_share_their_start(spark):
    """The factored searches find what their alternatives find, and try them at one place each."""
    from importlens.llm.license_scan import ANY_SPELLING, COPYRIGHT, COPYRIGHT_LINE
    from importlens.llm.licence_texts import SPELLINGS
    assert all(p.startswith(" ") for p, _ in SPELLINGS) and ANY_SPELLING.startswith(" (?:") and COPYRIGHT_LINE.count("^") == 3
    words = ["licence", "sublicences", "sub  licensable", "acknowledgements", "analogue", "organisation", "favourite", "labelling", "fulfils",
             "defences", "centres", "artefact", "programme", "practised", "whilst", "wilful", "non  commercial", "per  cent",
             "copyright  owners", "https", "license", "whilsts", "xwhilst", ""]
    heads = ["copyright 2020", "Copyright".lower(), "-- (c) <", "© [", "copyright by x", "all rights reserved.", "all rights reserved. x", "x all rights reserved",
             "(c)\t(c)", "copyright  199", "** copyright©", "all rights reserved\r", ""]
    rows = [(f" {w} ",) for w in words] + [(f" a  {w}  b ",) for w in words] + [(f"{w} ",) for w in words] + [(h,) for h in heads]
    t = F.col("t")
    single = F.lit(False)
    for p, _ in SPELLINGS:
        single = single | t.rlike(p)
    got = spark.createDataFrame(rows, "t string").select(
        "t", t.rlike(ANY_SPELLING).alias("any"), single.alias("single"), t.rlike(COPYRIGHT_LINE).alias("line"), t.rlike(COPYRIGHT).alias("old")).collect()
    assert [(r.t, r.any, r.line) for r in got] == [(r.t, r.single, r.old) for r in got]
    assert 0 < sum(r.any for r in got) < len(got) and 0 < sum(r.line for r in got) < len(got)
