r"""Licence scans: canonical digests of whole texts, joined with the digests of known licences.

Canonical form: lower case; copyright lines (``Copyright (c) 2020 …``,
``All rights reserved``) go; every run of other characters than letters and
digits separates words; spellings that count as equal become one. The digest of
a whole text is looked up among those of the known texts, and so is the digest
of each of its lines, which finds one-line notices inside documents.

The known texts are a parameter (``license_id, text``); the default catalogue is
a fixed list. Only their digests are broadcast, under Spark's own threshold.

Defined results: null and empty texts, and lines without words, match nothing.
Rows that repeat a ``doc_id`` add up in ``matches``; a null id is an id. Extra
columns are ignored. A document that matches nothing has no row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import table
from importlens.llm.licence_texts import SPELLINGS, TEXTS, TITLES

SEPARATORS = r"[^\p{L}\p{N}]+"
COPYRIGHT = (r"^[^\p{L}\p{N}]*(copyright|\(c\)|©)[ \t]*(\(c\)|©|[0-9]{4}|<|\[|by )"
             r"|^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*$")
# The same two searches with their common start in front, so that most places of a text are tried once and not once an alternative.
COPYRIGHT_LINE = (r"^[^\p{L}\p{N}]*(?:(?:copyright|\(c\)|©)[ \t]*(?:\(c\)|©|[0-9]{4}|<|\[|by )"
                  r"|all rights reserved[^\p{L}\p{N}]*$)")
ANY_SPELLING = " (?:" + "|".join(p.removeprefix(" ") for p, _ in SPELLINGS) + ")"


def _spelled(words: Column) -> Column:
    out = words
    for pattern, by in SPELLINGS:
        out = F.regexp_replace(out, pattern, re.sub(r"\\(\d)", r"$\1", by))
    return F.when(words.rlike(ANY_SPELLING), out).otherwise(words)   # most texts have none: one pass


def _plain(words: Column) -> Column:
    return F.trim(F.regexp_replace(words, " +", " "))


def word_lines(text: Column) -> Column:
    """The lines of a text without copyright lines; words stand between spaces of their own."""
    lines = F.filter(F.split(F.lower(text.cast("string")), "\n", -1), lambda x: ~x.rlike(COPYRIGHT_LINE))
    return F.transform(lines, lambda x: F.concat(F.lit(" "), F.regexp_replace(x, SEPARATORS, "  "), F.lit(" ")))


def unit_digests(texts: DataFrame, key: str) -> DataFrame:
    """Rows ``(key, scope, digest)``: the whole text and, where there are several, its lines."""
    lines = texts.select(key, word_lines(F.col("text")).alias("lines"))
    units = lines.select(key, F.concat(
        F.array(F.struct(F.lit("text").alias("scope"), _plain(_spelled(F.array_join("lines", ""))).alias("unit"))),
        F.when(F.size("lines") > 1, F.transform("lines", lambda x: F.struct(
            F.lit("line").alias("scope"), _plain(_spelled(x)).alias("unit")))).otherwise(F.array())).alias("units"))
    units = units.select(key, F.explode(F.filter("units", lambda u: u["unit"] != "")).alias("u"))
    return units.select(key, "u.scope", F.md5("u.unit").alias("digest"))


def known_licenses(spark: SparkSession) -> DataFrame:
    """The fixed catalogue as rows ``(license_id, text)``, with and without the licences' titles."""
    rows = [(i, t) for i, texts in TEXTS.items() for t in texts]
    rows += [(i, f"{title} {TEXTS[i][0]}") for i, title in TITLES.items()]
    known = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in rows])
    return spark.range(1).select(F.explode(known).alias("k")).select("k.license_id", "k.text")


def license_matches(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows ``(doc_id, license_id, scope, matches)`` of whole texts and lines that are a known text."""
    digests = unit_digests(known, "license_id").where("scope = 'text'").select("license_id", "digest").distinct()
    found = unit_digests(docs, "doc_id").join(digests, "digest")
    return found.groupBy("doc_id", "license_id", "scope").agg(F.count("*").alias("matches"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in all documents: whole texts and single lines."""
    return license_matches(table(spark, sf_dir, "documents"), known_licenses(spark))


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    spelled = "w"
    for pattern, by in SPELLINGS:
        spelled = f"regexp_replace({spelled}, {quoted(pattern)}, {quoted(by)}, 'g')"
    rows = [(i, t) for i, texts in TEXTS.items() for t in texts]
    rows += [(i, f"{title} {TEXTS[i][0]}") for i, title in TITLES.items()]
    values = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in rows)

    def units(source: str, key: str) -> str:
        return f"""
  SELECT {key}, scope, md5(trim(regexp_replace({spelled}, ' +', ' ', 'g'))) AS digest
  FROM (
    SELECT {key}, 'text' AS scope, array_to_string(lines, '') AS w FROM {source}
    UNION ALL
    SELECT {key}, 'line', unnest(lines) FROM {source} WHERE len(lines) > 1)
  WHERE trim({spelled}) <> ''"""

    def lines(source: str, key: str) -> str:
        return f"""
  SELECT {key}, list_transform(
    list_filter(string_split(lower(text), chr(10)), lambda x: NOT regexp_matches(x, {quoted(COPYRIGHT)})),
    lambda x: ' ' || regexp_replace(x, {quoted(SEPARATORS)}, '  ', 'g') || ' ') AS lines
  FROM {source} WHERE text IS NOT NULL"""

    return f"""
WITH known(license_id, text) AS (VALUES {values}),
known_lines AS ({lines('known', 'license_id')}),
doc_lines AS ({lines('documents', 'doc_id')}),
known_digests AS (SELECT DISTINCT license_id, digest FROM ({units('known_lines', 'license_id')}) WHERE scope = 'text'),
doc_digests AS ({units('doc_lines', 'doc_id')})
SELECT doc_id, license_id, scope, count(*) AS matches
FROM doc_digests JOIN known_digests USING (digest) GROUP BY doc_id, license_id, scope
"""


ORACLE = _oracle()
