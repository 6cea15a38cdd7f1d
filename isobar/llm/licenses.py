"""Licences of files: TF-IDF cosine to templates, inherited down the directories. DataFrame operations only.

Two comparisons, both by the cosine of TF-IDF vectors over lower-case words, with the weights

    (1 + ln(count)) * (1 + ln((1 + n) / (1 + templates with the word)))

for n templates of the kind.

* Headers: every line of a file, and comment lines also joined with the next one or two, since notices wrap, is compared
  with the notices. The closest counts if its cosine is ``least`` or more; ties go to the first notice by name, then to the earlier
  line, then to fewer lines.
* Licence files: the whole file is compared with whole licence texts; the closest counts if its cosine
  is ``least_file`` or more, which leaves room for names and years (other licences reach 0.7 at most, but for variants of one). ``texts`` adds or replaces texts.

A file's own licence is that of the whole text it is, else that of its closest header. A licence file declares
its licence for its directory: that is a whole text, or a file of which a header makes up ``file_share`` of
the words or more. A file without a licence of its own inherits that of the nearest directory above
that has a licence file; of several in one directory the closest counts, ties by name.

At scale. Texts are taken apart only where they hold a word without which no template can be reached,
so no match is lost; texts are compared once for all their copies. Templates are a parameter of the call, so
broadcasting them is bounded. Directories are resolved once each, not once for each file below
them, so a directory with a third of all files is one row of the path join, and files meet
their own directory only, in a join that Spark may split.

Null or empty texts have no licence of their own; a null path is the root's. Repeated rows come
back each.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isobar.llm.common import col, text_of
from isobar.llm.components import written
from isobar.llm.license_texts import NOTICES, TEXTS

#: Only for speed: texts hold these anyway, so they are poor marks of a licence.
COMMON = {
    "a", "all", "and", "are", "as", "be", "do", "for", "in", "into", "is", "it", "not", "of", "on", "or", "that", "the", "this", "to",
    "under", "use", "we", "with", "you", "0", "1", "2", "3", "4", "an", "at", "by", "from", "mit", "no",
}
LEAST, LEAST_FILE = 0.6, 0.85
FILE_SHARE = 0.3
#: Comment lines that are joined at most, and how they begin.
JOINED = 3
COMMENT = r"^\s*(//|#|/?\*|;|--|%|<!--)"
WORD = r"[a-z0-9]+"


def template_weights(templates: dict[str, str]) -> tuple[dict[str, dict[str, float]], dict[str, float], float]:
    """Unit vectors of the templates, the inverse document frequency of each word, and of any other word."""
    counts = {name: Counter(re.findall(WORD, text.lower())) for name, text in templates.items()}
    n = len(templates)
    frequency = Counter(w for c in counts.values() for w in c)
    idf = {w: 1 + math.log((1 + n) / (1 + f)) for w, f in frequency.items()}
    vectors = {}
    for name, count in counts.items():
        raw = {w: (1 + math.log(k)) * idf[w] for w, k in count.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        vectors[name] = {w: v / length for w, v in raw.items()}
    return vectors, idf, 1 + math.log(1 + n)


def marking_words(vectors: dict[str, dict[str, float]], least: float) -> list[str]:
    """Words of which a line must hold one to reach the cosine: for each template the heaviest, common
    words last, until the others together cannot reach it."""
    out: set[str] = set()
    for vector in vectors.values():
        ranked = sorted(vector, key=lambda w: (w in COMMON, -vector[w], w))
        while ranked and math.sqrt(sum(vector[w] ** 2 for w in ranked)) >= least - 1e-9:
            out.add(ranked.pop(0))
    return sorted(out)


def template_table(spark: SparkSession, vectors: dict[str, dict[str, float]], idf: dict[str, float]) -> DataFrame:
    rows = [(name, w, weight, idf[w]) for name, vector in sorted(vectors.items()) for w, weight in vector.items()]
    return spark.createDataFrame(rows, "license string, word string, weight double, idf double")


def any_of(words: list[str]) -> str:
    """Pattern of a text that holds one of the words."""
    return rf"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])"


def words_in(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)


def cosines(units: DataFrame, key: list[str], templates: dict[str, str]) -> DataFrame:
    """(key, license, cosine) of units (key, words) and templates that share a word."""
    vectors, idf, other = template_weights(templates)
    weights = template_table(units.sparkSession, vectors, idf)
    counted = units.select(*key, F.explode("words").alias("word")).groupBy(*key, "word").agg(
        (1 + F.log(F.count(F.lit(1)))).alias("tf")
    )
    # Per word its weights in all templates, so that a unit's words are read once.
    by_word = weights.groupBy("word", "idf").agg(F.collect_list(F.struct("license", "weight")).alias("of"))
    joined = counted.join(F.broadcast(by_word), "word", "left").withColumn(
        "value", F.col("tf") * F.coalesce("idf", F.lit(other))
    )
    lengths = joined.groupBy(*key).agg(
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length"),
        F.flatten(
            F.collect_list(
                F.transform("of", lambda t: F.struct(t["license"].alias("license"), (t["weight"] * F.col("value")).alias("dot")))
            )
        ).alias("dots"),
    )
    dots = lengths.select(*key, "length", F.inline("dots")).groupBy(*key, "length", "license").agg(F.sum("dot").alias("dot"))
    return dots.select(*key, "license", F.round(F.col("dot") / F.col("length"), 9).alias("cosine"))


def best_headers(texts: DataFrame, notices: dict[str, str], least: float) -> DataFrame:
    """(row, license, cosine, line, unit_words) of each text's closest header, if it is close enough."""
    marks = any_of(marking_words(template_weights(notices)[0], least))
    lines = F.split("text", "\n")

    def from_line(_: Column, i: Column) -> Column:
        """struct(line, lines, unit): the line, and with it the next ones as long as all are comments."""
        run = F.slice(lines, i + 1, JOINED)
        other = F.transform(run, lambda line, k: F.when(~line.rlike(COMMENT), k))
        size = F.greatest(F.coalesce(F.array_min(other), F.size(run)), F.lit(1))
        return F.transform(
            F.sequence(F.lit(1), size),
            lambda n: F.struct(i.alias("line"), n.alias("lines"), F.array_join(F.slice(run, F.lit(1), n), "\n").alias("unit")),
        )

    units = F.flatten(F.transform(lines, from_line))
    marked = texts.select("row", F.inline(units)).where(F.lower("unit").rlike(marks))
    split = marked.select("row", "line", "lines", words_in(F.col("unit")).alias("words")).withColumn("unit_words", F.size("words"))
    found = cosines(split, ["row", "line", "lines", "unit_words"], notices).where(F.col("cosine") >= least)
    best = F.min(F.struct((-F.col("cosine")).alias("far"), "license", "line", "lines", "unit_words")).alias("best")
    return found.groupBy("row").agg(best).select(
        "row", F.col("best.license").alias("license"), (-F.col("best.far")).alias("cosine"), "best.line", "best.unit_words"
    )


def best_texts(texts: DataFrame, templates: dict[str, str], least: float) -> DataFrame:
    """(row, license, cosine) of each text's closest whole licence text, if it is close enough."""
    units = texts.select("row", words_in(F.col("text")).alias("words"))
    found = cosines(units, ["row"], templates).where(F.col("cosine") >= least)
    best = found.groupBy("row").agg(F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("best"))
    return best.select("row", F.col("best.license").alias("license"), (-F.col("best.far")).alias("cosine"))


def directory_of(path: Column) -> Column:
    """The path without its last part; empty for the root."""
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """struct(up, directory) for the directory and all above it, the root as the empty path."""
    parts = F.split(directory, "/")
    depth = F.when(directory == "", 0).otherwise(F.size(parts))
    return F.transform(
        F.sequence(F.lit(0), depth),
        lambda up: F.struct(up.alias("up"), F.array_join(F.slice(parts, F.lit(1), depth - up), "/").alias("above")),
    )


def scan_licenses(
    files: DataFrame, *, id_col: str, path: Column, text_col: str = "text", notices: dict[str, str] | None = None,
    texts: dict[str, str] | None = None, least: float = LEAST, least_file: float = LEAST_FILE, file_share: float = FILE_SHARE,
) -> DataFrame:
    """Per file (id, path, license, cosine, line, found): ``found`` is ``own`` or ``inherited``, else all
    four are null. Cosine belongs to a licence of the file's own; line, from 0, to a header and not to a whole text."""
    notices, whole = NOTICES if notices is None else notices, TEXTS | (texts or {})
    rows = files.select(
        col(id_col).alias("id"), F.coalesce(path, F.lit("")).alias("path"), text_of(text_col).alias("text"),
    ).withColumn("row", F.xxhash64("text"))

    def marked(templates: dict[str, str], bound: float) -> DataFrame:
        """Texts that may reach the cosine, once for all copies."""
        marks = any_of(marking_words(template_weights(templates)[0], bound))
        return rows.where(F.lower("text").rlike(marks)).groupBy("row").agg(F.min("text").alias("text"))

    noticed = marked(notices, least)
    headers, full = best_headers(noticed, notices, least), best_texts(marked(whole, least_file), whole, least_file)
    sizes = noticed.select("row", F.size(words_in(F.col("text"))).alias("words"))
    is_text = F.col("f.license").isNotNull()
    own = written(
        headers.join(sizes, "row").alias("h").join(full.alias("f"), "row", "full").select(
            "row", F.coalesce("f.license", "h.license").alias("license"), F.coalesce("f.cosine", "h.cosine").alias("cosine"),
            F.when(~is_text, F.col("h.line")).alias("line"),
            (is_text | (F.col("h.unit_words") >= file_share * F.col("h.words"))).alias("is_file"),
        ),
        "licenses",
    )
    placed = rows.select("id", "path", "row", directory_of(F.col("path")).alias("directory")).join(own, "row", "left")
    declared = placed.where("is_file").groupBy(F.col("directory").alias("above")).agg(
        F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("best")
    ).select("above", F.col("best.license").alias("inherited"))
    directories = rows.select(directory_of(F.col("path")).alias("directory")).distinct()
    climbed = directories.select("directory", F.inline(ancestors(F.col("directory"))))
    resolved = climbed.join(declared, "above").groupBy("directory").agg(F.min_by("inherited", "up").alias("inherited"))
    done = placed.join(resolved, "directory", "left")
    found = F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited")
    return done.select(
        F.col("id").alias(id_col), "path", F.coalesce("license", "inherited").alias("license"), "cosine", "line",
        found.alias("found"),
    )


def _values(templates: dict[str, str]) -> tuple[str, float]:
    vectors, idf, other = template_weights(templates)
    return ", ".join(
        f"('{name}', '{w}', {weight!r}::DOUBLE, {idf[w]!r}::DOUBLE)"
        for name, vector in sorted(vectors.items()) for w, weight in vector.items()
    ), other


def sql(id_col: str, path: str, source: str) -> str:
    """The same over a table ``source``, its paths by the expression ``path``, for DuckDB: every line, alone and joined, and
    every file is compared, whatever words it holds."""

    def compared(name: str, key: str, templates: dict[str, str]) -> str:
        values, other = _values(templates)
        return f"""{name}_weights(license, word, weight, idf) AS (VALUES {values}),
{name}_words AS (SELECT {key}, unnest(words) AS word FROM {name}_units),
{name}_counted AS (SELECT {key}, word, 1 + ln(count(*)) AS tf FROM {name}_words GROUP BY ALL),
{name}_lengths AS (
    SELECT {key}, sqrt(sum((tf * coalesce(idf, {other!r})) ** 2)) AS length
    FROM {name}_counted LEFT JOIN (SELECT DISTINCT word, idf FROM {name}_weights) USING (word) GROUP BY ALL
),
{name}_dots AS (SELECT {key}, license, sum(tf * idf * weight) AS dot FROM {name}_counted JOIN {name}_weights USING (word) GROUP BY ALL),
{name}_matches AS (SELECT {key}, license, round(dot / length, 9) AS cosine FROM {name}_dots JOIN {name}_lengths USING ({key}))"""

    return f"""
WITH files AS (SELECT row_number() OVER () AS file, {id_col} AS id, {path} AS path, coalesce(text, '') AS text FROM {source}),
sized AS (SELECT *, regexp_extract_all(lower(text), '{WORD}') AS words FROM files),
lines AS (SELECT file, unnest(range(len(parts))) AS line, unnest(parts) AS text FROM (SELECT file, string_split(text, chr(10)) AS parts FROM files)),
joined AS (
    SELECT file, line, n AS lines, text AS unit FROM lines, (VALUES (1)) one(n)
    {" ".join(f"""UNION ALL SELECT l.file, l.line, {n}, {" || ' ' || ".join(['l.text', *(f'l{k}.text' for k in range(1, n))])}
    FROM lines l {" ".join(f"JOIN lines l{k} ON l{k}.file = l.file AND l{k}.line = l.line + {k}" for k in range(1, n))}
    WHERE {" AND ".join(f"regexp_matches({t}.text, '{COMMENT}')" for t in ['l', *(f'l{k}' for k in range(1, n))])}"""
    for n in range(2, JOINED + 1))}
),
header_units AS (SELECT file, line, lines, regexp_extract_all(lower(unit), '{WORD}') AS words FROM joined),
{compared("header", "file, line, lines", NOTICES)},
header AS (
    SELECT m.file, m.license, m.cosine, m.line, len(u.words) AS unit_words
    FROM header_matches m JOIN header_units u USING (file, line, lines) WHERE cosine >= {LEAST}
    QUALIFY row_number() OVER (PARTITION BY m.file ORDER BY cosine DESC, license, line, lines) = 1
),
file_units AS (SELECT file, words FROM sized),
{compared("file", "file", TEXTS)},
whole AS (
    SELECT * FROM file_matches WHERE cosine >= {LEAST_FILE}
    QUALIFY row_number() OVER (PARTITION BY file ORDER BY cosine DESC, license) = 1
),
placed AS (
    SELECT s.file, id, path, regexp_replace(path, '/?[^/]*$', '') AS directory, coalesce(w.license, h.license) AS license,
        coalesce(w.cosine, h.cosine) AS cosine, CASE WHEN w.license IS NULL THEN line END AS line,
        w.license IS NOT NULL OR unit_words >= {FILE_SHARE} * len(words) AS is_file
    FROM sized s LEFT JOIN header h USING (file) LEFT JOIN whole w USING (file)
),
declared AS (
    SELECT directory AS above, arg_min(license, (-cosine, license)) AS inherited FROM placed WHERE is_file GROUP BY 1
),
resolved AS (
    SELECT d.directory, arg_min(inherited, length(d.directory) - length(above)) AS inherited
    FROM (SELECT DISTINCT directory FROM placed) AS d JOIN declared
        ON above = d.directory OR above = '' OR starts_with(d.directory, above || '/')
    GROUP BY 1
)
SELECT id AS {id_col}, path, coalesce(license, inherited) AS license, round(cosine, 6) AS cosine,
    CAST(line AS INTEGER) AS line,
    CASE WHEN license IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' END AS found
FROM placed LEFT JOIN resolved USING (directory)
"""
