"""Licences of files: sparse TF-IDF cosine to templates, then inheritance along paths.

Only DataFrame operations. A text is cut into statements (lines and sentences). Statements
with a word of licensing become sparse TF-IDF vectors, with document frequencies over all
statements and templates, and are compared with the template vectors by a join on tokens,
so only pairs that share a token exist. Whole texts, leading comment blocks and blocks anywhere
in a text are compared with the texts and headers in ``licence_texts`` the same way; a text
without the rare tokens that a cosine of ``WHOLE`` needs is left out first. A block is the run
of paragraphs, between blank lines and without the marks of comments, that are like
paragraphs of one template; so a file may hold several licences, each behind other text. An
SPDX identifier names its licence. A file that consists mostly of such statements, or
has the name of a licence file, gives its licence to its directory. A file without a
licence of its own takes that of its nearest ancestor directory, found by joins of paths.
"""

from __future__ import annotations

import functools
import math
import operator
import pathlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.shared import written

COSINE = 0.55
#: Least cosine of a whole text or header with a whole template.
WHOLE = 0.75
#: Least cosine of a paragraph with one of a template, its least words, and paragraphs without
#: a match that a block may hold.
PARAGRAPH, PARAGRAPH_WORDS, GAP = 0.6, 5, 2
#: Share of a text's words in licence statements that makes it a licence file.
SHARE = 0.5

#: Fixed statements, one per form, by licence.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, MIT License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]
_CUE = r"(?i)\b(licen[sc]e[sd]?|licensing|released under|copyright|permission is hereby|public domain|spdx)"
_CUES = ("licens", "licenc", "released under", "copyright", "permission is hereby", "public domain", "spdx")
_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)(\.[a-z]+)?$"
_SPDX = r"(?i)SPDX-License-Identifier:[ \t]*\(?([a-z0-9.\-]+)"
_COMMENT = r"^\s*(#|//|/\*|\*|--|;|<!--|%)"
_STATEMENT = r"\n|(?<=[.!?])\s+"


def _tokens(text):
    """Distinct-case-free tokens; versions and hyphenated names stay whole."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.\-]+|\.(?=$|[^a-z0-9])"), lambda t: t != "")


def _weights(statements: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """``key, token, weight``: unit-length TF-IDF vectors."""
    tf = statements.select(key, F.explode(_tokens(F.col("statement"))).alias("token")).groupBy(key, "token").agg(F.count("*").alias("tf"))
    raw = tf.join(idf, "token").select(key, "token", (F.col("tf") * F.col("idf")).alias("w"))
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, key).select(key, "token", (F.col("w") / F.col("norm")).alias("weight"))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template int, licence string, statement string")


def statements(files: DataFrame) -> DataFrame:
    """``file, statement, form, words, total``: statements of whole texts with a word of
    licensing, their number of words, and that of the text."""
    text = F.coalesce("text", F.lit(""))
    low = F.lower(text)
    # Plain search first: only texts that hold a word of licensing are cut.
    worth = functools.reduce(operator.or_, [F.contains(low, F.lit(w)) for w in _CUES])
    total = F.size(F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != ""))
    return (
        files.filter(worth)
        .select("file", total.alias("total"), F.explode(F.split(text, _STATEMENT)).alias("statement"))
        .filter(F.col("statement").rlike(_CUE))
        .select(
            "file", "total", "statement", F.xxhash64(F.lower("statement")).alias("form"), F.size(_tokens(F.col("statement"))).alias("words")
        )
    )


def matched(found: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``form, licence, score``: the best template of each distinct one of ``statements``."""
    known = templates(found.sparkSession)
    forms = found.groupBy("form").agg(F.min("statement").alias("statement"), F.count("*").alias("seen"))
    # Document frequencies: how many statements of the corpus and templates hold a token.
    counted = forms.select("statement", "seen").unionByName(known.select("statement", F.lit(1).cast("long").alias("seen")))
    df = counted.select(F.explode(F.array_distinct(_tokens(F.col("statement")))).alias("token"), "seen").groupBy("token").agg(F.sum("seen").alias("df"))
    total = counted.agg(F.sum("seen")).scalar()
    idf = df.select("token", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    own = _weights(known, "template", idf).withColumnRenamed("weight", "other")
    pairs = (
        _weights(forms, "form", idf)
        .join(F.broadcast(own), "token")  # as many rows as the templates have tokens
        .groupBy("form", "template")
        .agg(F.sum(F.col("weight") * F.col("other")).alias("score"))
        .join(F.broadcast(known.select("template", "licence")), "template")
    )
    best = F.max_by(F.struct("licence", "score"), F.struct(F.round("score", 9), -F.col("template"))).alias("best")
    return pairs.groupBy("form").agg(best).select("form", "best.licence", "best.score").filter(F.col("score") >= cosine)


def whole_templates() -> list[tuple[str, str]]:
    """Licence and text of each file of ``licence_texts``."""
    found = sorted((pathlib.Path(__file__).parent / "licence_texts").glob("*.txt"))
    return [(p.name.removesuffix(".txt").removesuffix(".header"), p.read_text()) for p in found]


def _units(files: DataFrame) -> DataFrame:
    """``file, total, body``: whole texts, and the comment blocks that texts begin with."""
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    other = F.array_position(F.transform(lines, lambda x: ~x.rlike(_COMMENT)), True)
    head = F.when(text.rlike(_COMMENT) & (other > 1), F.array_join(F.slice(lines, F.lit(1), (other - 1).cast("int")), "\n"))
    total = F.size(F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != ""))
    bodies = F.filter(F.array(text, head), lambda b: b.isNotNull())
    return files.select("file", "text", F.explode(bodies).alias("body")).withColumn("total", total).drop("text")


def _paragraphs(body):
    """Paragraphs between blank lines, without the marks of comments."""
    return F.split(F.regexp_replace(body, r"(?m)^[ \t]*(#+|//+|/\*+|\*+/?|--+|;+|<!--|%+)|-->[ \t]*$", ""), r"\n[ \t\r]*\n\s*")


def _cosines(parts: DataFrame, weights: DataFrame, idfs: DataFrame, unseen: float, least: float) -> DataFrame:
    """``form, template, score`` of distinct ``parts(form, body)`` that are like a template.

    ``weights(template, token, other)`` has unit vectors; weights of a part are
    (1 + ln tf) * idf, those of unknown tokens like unseen ones.
    """
    vectors = (
        parts.select("form", F.explode(_tokens(F.col("body"))).alias("token"))
        .groupBy("form", "token")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(idfs), "token", "left")
        .select("form", "token", ((F.log("tf") + 1) * F.coalesce("idf", F.lit(unseen))).alias("w"))
    )
    norms = vectors.groupBy("form").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return (
        vectors.join(F.broadcast(weights), "token")
        .groupBy("form", "template")
        .agg(F.sum(F.col("w") * F.col("other")).alias("dot"))
        .join(norms, "form")
        .withColumn("score", F.col("dot") / F.col("norm"))
        .filter(F.col("score") >= least)
        .select("form", "template", "score")
    )


def _unit_vectors(counts: dict, idf: dict) -> dict:
    """Unit TF-IDF vectors of templates, by (template, token)."""
    raw = {(i, t): (1 + math.log(n)) * idf[t] for (i, t), n in counts.items()}
    norm: dict = {}
    for (i, _), w in raw.items():
        norm[i] = norm.get(i, 0.0) + w * w
    return {(i, t): w / math.sqrt(norm[i]) for (i, t), w in raw.items()}


def _blocks(units: DataFrame, paragraphs: DataFrame, idfs: DataFrame, unseen: float) -> DataFrame:
    """``file, unit, low, high, total, body`` of the runs of paragraphs that are like those of
    one template.

    ``paragraphs`` has the unit vectors of template paragraphs with their ``whole`` template.
    """
    cut = written(
        units.select("file", "total", F.col("form").alias("unit"), F.posexplode(_paragraphs(F.col("body"))).alias("at", "body"))
        .withColumn("form", F.xxhash64(F.lower("body"))),
        "paragraphs",
    )
    enough = F.size(_tokens(F.col("body"))) >= PARAGRAPH_WORDS
    parts = cut.filter(enough).groupBy("form").agg(F.min("body").alias("body"))
    of = paragraphs.select("template", "whole").distinct()
    like = _cosines(parts, paragraphs.drop("whole"), idfs, unseen, PARAGRAPH).join(F.broadcast(of), "template").select("form", "whole").distinct()
    order = Window.partitionBy("file", "unit", "whole").orderBy("at")
    begins = F.coalesce(F.col("at") - F.lag("at").over(order) > GAP + 1, F.lit(True)).cast("int")
    runs = (
        cut.select("file", "unit", "at", "form").distinct().join(like, "form")
        .withColumn("begins", begins)
        .withColumn("run", F.sum("begins").over(order))
        .groupBy("file", "unit", "whole", "run")
        .agg(F.min("at").alias("low"), F.max("at").alias("high"))
        .select(F.col("file").alias("_file"), F.col("unit").alias("_unit"), "low", "high")
        .distinct()
    )
    inside = F.col("file").eqNullSafe(F.col("_file")) & (F.col("unit") == F.col("_unit")) & F.col("at").between(F.col("low"), F.col("high"))
    body = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("at", "body"))), lambda x: x["body"]), "\n\n")
    return cut.join(runs, inside).groupBy("file", "unit", "low", "high").agg(F.max("total").alias("total"), body.alias("body"))


def wholes(files: DataFrame, cosine: float = WHOLE) -> DataFrame:
    """``file, licence, score, words, total``: whole texts, headers and blocks like a template.

    Weights are (1 + ln tf) * idf, with document frequencies over all texts and templates for
    the tokens of templates; other tokens weigh as unseen ones.
    """
    spark = files.sparkSession
    rows = [(i, name, text) for i, (name, text) in enumerate(whole_templates())]
    known = spark.createDataFrame(rows, "template int, licence string, body string")
    split = known.select("template", F.posexplode(_paragraphs(F.col("body"))).alias("at", "body"))
    counts = lambda df, *key: {((*(r[k] for k in key),), r.token): r["count"] for r in df.select(*key, F.explode(_tokens(F.col("body"))).alias("token")).groupBy(*key, "token").count().collect()}
    tf = {(i, t): n for ((i,), t), n in counts(known, "template").items()}
    vocabulary = sorted({t for _, t in tf})
    once = F.array_distinct(_tokens(F.col("text")))
    # One pass cuts all texts; they are kept beside the tokens of templates that they hold.
    held = written(files.select("file", "text", F.filter(once, lambda t: t.isin(vocabulary)).alias("held")), "held")
    df = {r.token: r["count"] for r in held.select(F.explode("held").alias("token")).groupBy("token").count().collect()}
    for _, t in tf:
        df[t] = df.get(t, 0) + 1
    total = files.count() + len(rows)
    idf = {t: math.log((total + 1) / (n + 1)) + 1 for t, n in df.items()}
    unseen = math.log(total + 1) + 1
    own = _unit_vectors(tf, idf)
    # The squares of the weights that a text shares with a template reach the squared cosine,
    # so a text has one of the rare tokens that are left when the commonest fall short of it.
    rare = set()
    for i, _, _ in rows:
        left = cosine * cosine - 1e-9
        for t in sorted((t for j, t in own if j == i), key=lambda t: (-df[t], t)):
            left -= own[i, t] ** 2
            if left <= 0:
                rare.add(t)
    near = held.filter(F.arrays_overlap("held", F.array(*[F.lit(t) for t in sorted(rare)]))).select("file", "text")
    units = written(_units(near).withColumn("form", F.xxhash64(F.lower("body"))), "units")
    idfs = spark.createDataFrame(list(idf.items()), "token string, idf double")
    weights = spark.createDataFrame([(i, t, w) for (i, t), w in own.items()], "template int, token string, other double")
    long = {k: n for k, n in counts(split, "template", "at").items()}
    sizes: dict = {}
    for (k, _), n in long.items():
        sizes[k] = sizes.get(k, 0) + n
    pieces = _unit_vectors({k: n for k, n in long.items() if sizes[k[0]] >= PARAGRAPH_WORDS}, idf)
    paragraphs = spark.createDataFrame(
        [(i * 10_000 + at, t, w, i) for ((i, at), t), w in pieces.items()], "template int, token string, other double, whole int"
    )
    blocks = _blocks(units, paragraphs, idfs, unseen).withColumn("form", F.xxhash64(F.lower("body")))
    parts = written(units.unionByName(blocks, allowMissingColumns=True).withColumn("words", F.size(_tokens(F.col("body")))), "parts")
    best = F.max_by(F.struct("licence", "score"), F.struct(F.round("score", 9), -F.col("template"))).alias("best")
    found = (
        _cosines(parts.groupBy("form").agg(F.min("body").alias("body")), weights, idfs, unseen, cosine)
        .join(F.broadcast(known.select("template", "licence")), "template")
        .groupBy("form")
        .agg(best)
    )
    named = parts.join(found, "form").select("file", "best.licence", "best.score", "words", "total", "form", "unit", "low", "high")
    # Licences share paragraphs: a block inside a longer one that is a licence is part of it.
    outer = named.filter("unit is not null").select(F.col("file").alias("_file"), F.col("unit").alias("_unit"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    inside = (
        F.col("file").eqNullSafe(F.col("_file")) & (F.col("unit") == F.col("_unit")) & (F.col("_low") <= F.col("low"))
        & (F.col("_high") >= F.col("high")) & (F.col("_high") - F.col("_low") > F.col("high") - F.col("low"))
    )
    return named.join(outer, inside, "left_anti").select("file", "licence", "score", "words", "total", "form")


def identified(files: DataFrame) -> DataFrame:
    """``file, licence, score, words, total`` of texts with an SPDX identifier."""
    stated = F.regexp_replace(F.regexp_extract("text", _SPDX, 1), r"(?i)(-only|-or-later|\+|\.)$", "")
    return (
        files.filter(F.contains(F.lower("text"), F.lit("spdx-license-identifier")))
        .select("file", stated.alias("licence"), F.lit(1.0).alias("score"), F.lit(0).alias("words"), F.lit(0).alias("total"))
        .filter("licence <> ''")
        .withColumn("form", F.xxhash64("licence"))
    )


def ancestors(path):
    """Directories above a path, nearest first: ``struct(directory, up)``."""
    steps = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(steps) - 1),
        lambda up: F.struct(F.array_join(F.slice(steps, 1, F.size(steps) - up), "/").alias("directory"), up.alias("up")),
    )


def licences(files: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``file, path, licence, score, origin, licence_file, licences`` for each row of
    ``files(file, path, text)``.

    ``origin`` is ``own`` for a licence of the text itself (an SPDX identifier as it is stated,
    without -only and -or-later, then whole texts and headers, then statements; of several,
    the one with the best score; ``licences`` has in order all of the first kind that the text has), ``inherited`` for that of the nearest ancestor directory
    with a licence file, else null, as the licence is. Null and empty texts have no licence of
    their own. A null path inherits nothing and gives nothing. Rows that repeat a file number
    share their statements. Of several licence files in a directory the one with the best
    score, then the first path, counts. Other columns are ignored, whatever their names. An
    empty table gives no rows.
    """
    files = files.select("file", "path", "text")
    # Frequencies, norms and matches all start from the statements: texts are read once.
    found = written(statements(files), "statements")
    columns = ["file", "licence", "score", "words", "total", "form"]
    lines = found.join(matched(found, cosine), "form").select(*columns, F.lit(0).alias("whole"))
    wide = wholes(files).unionByName(identified(files)).select(*columns, F.lit(1).alias("whole"))
    of = lambda whole, c: F.when(F.col("whole") == whole, F.col(c))
    own = (
        lines.unionByName(wide)
        .groupBy("file")
        .agg(
            F.max_by(F.struct("licence", "score"), F.struct("whole", F.round("score", 9), F.col("form"))).alias("best"),
            # Statements of a whole licence may look like another's.
            F.array_sort(F.coalesce(F.nullif(F.collect_set(of(1, "licence")), F.array().cast("array<string>")), F.collect_set("licence"))).alias("licences"),
            F.greatest(F.sum(of(0, "words")), F.max(of(1, "words"))).alias("licence_words"),
            F.greatest(F.avg(of(0, "total")), F.max(of(1, "total"))).alias("total"),
        )
        .select(F.col("file").alias("_file"), "best.licence", "best.score", "licences", "licence_words", "total")
    )
    marked = (
        files.select("file", "path")
        .join(own, F.col("file").eqNullSafe(F.col("_file")), "left")
        .withColumn(
            "licence_file",
            F.col("licence").isNotNull()
            & F.coalesce(F.col("path").rlike(_FILE) | ((F.col("licence_words") > 0) & (F.col("licence_words") >= SHARE * F.col("total"))), F.lit(False)),
        )
        .select("file", "path", "licence", "score", "licence_file", F.coalesce("licences", F.array().cast("array<string>")).alias("licences"))
    )
    given = (
        marked.filter("licence_file and path like '%/%'")
        .groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("directory"))
        .agg(F.min_by(F.struct("licence", "score"), F.struct(-F.round("score", 9), "path")).alias("gift"))
    )
    # Directories, not files, look for their nearest ancestor, so a file joins once.
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    near = (
        marked.filter("path like '%/%'")
        .select(folder)
        .distinct()
        .select("folder", F.explode(F.concat(F.array(F.struct(F.col("folder").alias("directory"), F.lit(0).alias("up"))), ancestors(F.col("folder")))).alias("a"))
        .select("folder", "a.directory", "a.up")
        .join(given, "directory")
        .groupBy("folder")
        .agg(F.min_by("gift", "up").alias("gift"))
    )
    return (
        marked.withColumn("_folder", F.when(F.col("path").like("%/%"), F.regexp_replace("path", "/[^/]*$", "")))
        .join(near, F.col("_folder") == F.col("folder"), "left")
        .select(
            "file",
            "path",
            F.coalesce("licence", "gift.licence").alias("licence"),
            F.coalesce("score", "gift.score").alias("score"),
            F.when(F.col("licence").isNotNull(), "own").when(F.col("gift").isNotNull(), "inherited").alias("origin"),
            "licence_file",
            "licences",
        )
    )
