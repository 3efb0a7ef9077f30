"""Licence scan: sparse TF-IDF cosine to notice templates, then inheritance from the nearest directory.

Every line that can reach a template is compared with all of them: term counts times inverse document
frequency, cosine of the two sparse vectors, best template from :data:`THRESHOLD` on. Frequencies of the template terms are
counted over all documents; terms of no template weigh as terms that no document holds. Lines are scored once
each, however many documents repeat them. No cosine is above the length of the template's part that the line shares
(Cauchy-Schwarz), so lines for which that part is too short are left out without losing a pair.

A document is a licence file when its name says so or when at least half of its words stand in licence lines. A
document without a licence line of its own takes the licence of the licence file in its own directory or, failing that, in the nearest directory
above. Directories are resolved once each and then looked up, so a directory that holds a third of all documents is no hot key.

Column expressions and joins only. Null texts hold no line; null paths have no directory and inherit nothing; rows with a null id are scanned like others but
share one result. Ties go to the template listed first, then to the smaller id. Repeated rows count once. Other columns are not
read; empty tables give empty results; very long lines are one line like any other.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.binding import let
from wattmill.llm.common import ascii_lower, text_or_empty
from wattmill.operators.lookup import lookup
from wattmill.session import stage

# Licences and the notices by which texts name them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Proprietary", "All rights reserved."),
)
#: Words of licence lines; every template holds one.
ANCHORS = "licen[cs]|permission|redistribut|reserved"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z]+)?$"
THRESHOLD = 0.6
#: Squared threshold, less what sums of doubles may lose.
REACH = THRESHOLD * THRESHOLD - 1e-9
TERMS = "[^a-z0-9]+"


def terms(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), TERMS, -1), lambda t: t != "")


def _terms_of(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c.isascii() and c.isalnum() else " " for c in lowered).split()


def idf(found: int, total: int) -> float:
    return math.log((1 + total) / (1 + found)) + 1


def term_weights(docs: DataFrame, text: str, templates: Sequence[tuple[str, str]]) -> tuple[dict[str, float], float]:
    """Weights of the template terms from their counts over all documents, and the weight of any other term."""
    names = sorted({t for _, notice in templates for t in _terms_of(notice)})
    known = F.array_intersect(terms(text_or_empty(text)), F.array(*[F.lit(n) for n in names]))
    counts = docs.select(F.explode(F.array_append(known, F.lit(""))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    found = {r["term"]: r["n"] for r in counts.collect()}
    total = found.get("", 0)
    return {n: idf(found.get(n, 0), total) for n in names}, idf(0, total)


def shares(weights: dict[str, float], templates: Sequence[tuple[str, str]]) -> list[dict[str, float]]:
    """Per template the part of its squared length that each of its terms makes up."""
    vectors = [{t: n * weights[t] for t, n in Counter(_terms_of(notice)).items()} for _, notice in templates]
    return [{t: v * v / sum(x * x for x in vector.values()) for t, v in vector.items()} for vector in vectors]


def telling_terms(parts: Sequence[dict[str, float]]) -> list[str]:
    """Terms of which a line needs one at least to reach the threshold: the others of a template fall short of it all together."""
    found: set[str] = set()
    for part in parts:
        short = 0.0
        for term, share in sorted(part.items(), key=lambda p: (p[1], p[0])):
            short += share
            if short >= REACH:
                found.add(term)
    return sorted(found)


def reaches(line: Column, parts: Sequence[dict[str, float]]) -> Column:
    """Whether the terms that a line shares with some template make up enough of that template's length."""
    known = F.array_intersect(terms(line), F.array(*[F.lit(t) for t in sorted({t for part in parts for t in part})]))

    def enough(shared: Column) -> Column:
        far = F.lit(False)
        for part in parts:
            share = F.create_map(*[F.lit(x) for pair in part.items() for x in pair])
            far = far | (F.aggregate(shared, F.lit(0.0), lambda n, t: n + F.coalesce(F.element_at(share, t), F.lit(0.0))) >= REACH)
        return far

    return let(known, enough)


def score_lines(lines: DataFrame, weights: dict[str, float], other: float, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``line, licence, score`` for the distinct ``line`` values whose best template reaches the threshold."""
    by_term = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    counted = lines.select("line", F.explode(terms(F.col("line"))).alias("term")).groupBy("line", "term").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("w", F.col("n") * F.coalesce(F.element_at(by_term, F.col("term")), F.lit(other)))
    sums = [F.sum(F.col("w") * F.col("w")).alias("square")]
    for i, (_, notice) in enumerate(templates):
        vector = {t: n * weights[t] for t, n in Counter(_terms_of(notice)).items()}
        size = math.sqrt(sum(v * v for v in vector.values()))
        part = F.create_map(*[F.lit(x) for t, v in vector.items() for x in (t, v / size)])
        sums.append(F.sum(F.col("w") * F.coalesce(F.element_at(part, F.col("term")), F.lit(0.0))).alias(f"dot_{i}"))
    scored = counted.groupBy("line").agg(*sums)
    best = F.array_max(
        F.array(*[F.struct((F.col(f"dot_{i}") / F.sqrt("square")).alias("score"), F.lit(-i).alias("first"), F.lit(t[0]).alias("licence")) for i, t in enumerate(templates)])
    )
    return scored.select("line", best.alias("best")).select("line", "best.licence", "best.score").where(F.col("score") >= THRESHOLD)


def parent(path: Column) -> Column:
    """The directory of a path, without a slash at its end; the root is the empty text."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(docs: DataFrame, path: Column, key: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``id, licence, origin, directory``: ``origin`` is ``own``, ``inherited`` or null; ``directory`` is where an inherited licence file lies."""
    rows = docs.select(F.col(key).alias("id"), path.alias("path"), F.col(text).alias("text"))
    weights, other = term_weights(docs, text, templates)
    parts_of = shares(weights, templates)
    telling = f"(?<![a-z0-9])(?:{'|'.join(telling_terms(parts_of))})(?![a-z0-9])"
    hinted = rows.where(ascii_lower(F.col("text")).rlike(telling))
    lines = hinted.select(
        "id", "path", F.size(terms(F.col("text"))).alias("words"), F.explode(F.split("text", "\n", -1)).alias("line")
    ).where(ascii_lower(F.col("line")).rlike(telling)).where(reaches(F.col("line"), parts_of))
    lines = stage(lines, "licence-lines")
    scored = score_lines(lines.select("line").distinct(), weights, other, templates)
    ranked = lines.join(scored, "line").withColumn("in_line", F.size(terms(F.col("line"))))
    first = F.struct(F.col("score"), F.col("licence")).alias("best")
    per_line = ranked.select("id", "path", "words", "line", "in_line", first).distinct()
    own = per_line.groupBy("id", "path").agg(F.max("best").alias("best"), F.sum("in_line").alias("inside"), F.max("words").alias("words"))
    own = stage(own.select("id", "path", "best", ((2 * F.col("inside") >= F.col("words")) | F.col("path").rlike(LICENCE_FILE)).alias("file")), "own-licences")

    files = own.where("file").where(F.col("path").isNotNull())
    held = files.groupBy(parent(F.col("path")).alias("directory")).agg(
        F.max(F.struct(F.col("best.score").alias("score"), (-F.col("id")).alias("first"), F.col("best.licence").alias("licence"))).alias("file")
    ).select("directory", F.col("file.licence").alias("licence"))
    directories = rows.where(F.col("path").isNotNull()).select(parent(F.col("path")).alias("own_directory")).distinct()
    parts = F.split("own_directory", "/", -1)
    above = directories.select(
        "own_directory",
        F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("directory"),
    ).distinct()
    near = above.join(held, "directory").groupBy("own_directory").agg(
        F.max(F.struct(F.length("directory").alias("depth"), F.col("directory"), F.col("licence"))).alias("near")
    )

    of_id = own.groupBy("id").agg(F.max("best").alias("best"))
    every = rows.select("id", "path").distinct().withColumn("own_directory", parent(F.col("path")))
    every = every.join(of_id.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left").drop("_id")
    found = lookup(every.select("id", "path", "own_directory", "best"), near, ["own_directory"])
    mine, theirs = F.col("best.licence"), F.col("near.licence")
    return found.select(
        "id",
        F.coalesce(mine, theirs).alias("licence"),
        F.when(mine.isNotNull(), "own").when(theirs.isNotNull(), "inherited").alias("origin"),
        F.when(mine.isNull(), F.col("near.directory")).alias("directory"),
    )
