"""Line dedup by a log-template tree of fixed depth.

A line is parsed down a tree: by its number of tokens, then its leading tokens, then the contents of its remaining
fields, in which variable fields are generalised. A token with a digit is always variable. Beyond that, the rest of a
line of MIN_TOKENS tokens or more is cut into FIELDS runs of tokens, and the line reaches a leaf for each run taken as
variable, from MIN_PAIR_TOKENS tokens on for each pair of runs. So two lines share a template if they agree but for
digits, or but for one or two runs; shorter lines if they agree but for digits. A template met in two documents or more
recurs; its lines stay in the document of the smallest doc_id and are dropped elsewhere.

Leaves are 64-bit hashes and a leaf needs only the smallest and largest doc_id, which combine before the shuffle, so a
line that a third of all documents share is as cheap as any other. No text is shuffled for the decision.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.batches import with_plain_names
from almanac.sources import materialise, table

LEADING = 2
FIELDS = 4
MIN_TOKENS = 5
MIN_PAIR_TOKENS = 10  # a pair of runs may be half of a line, too much of a shorter one
NO_ID = (1 << 63) - 1


def parsed(line: Column) -> Column:
    """Tokens of a line, those with a digit masked; a line without tokens has one empty token."""
    variable = r"(?<![^ \t\x0B\f\r])[^ \t\x0B\f\r0-9]*+[0-9][^ \t\x0B\f\r]*"
    masked = F.when(F.rlike(line, F.lit("[0-9]")), F.regexp_replace(line, variable, "<*>")).otherwise(line)
    return F.split(F.btrim(masked, F.lit(" \t\x0b\f\r")), r"[ \t\x0B\f\r]+")


def runs(tokens: Column, leading: int = LEADING, fields: int = FIELDS) -> Column:
    """Hashes of the leading tokens and of each run of the others, as an array."""
    n = F.size(tokens)

    def cut(i: int) -> Column:
        return F.lit(leading) + F.floor((n - leading) * i / fields).cast("int")

    kept = [F.slice(tokens, cut(i) + 1, cut(i + 1) - cut(i)) for i in range(fields)]
    return F.when(n >= MIN_TOKENS, F.array(*[F.xxhash64(part) for part in (F.slice(tokens, 1, leading), *kept)]))


def leaves(tokens: Column, line: Column, hashed: Column, fields: int = FIELDS) -> Column:
    """The leaves of the tree that a line reaches, as an array of longs; ``hashed`` are its ``runs``.

    Lines of MIN_PAIR_TOKENS tokens or more reach a leaf for each pair of runs taken as variable, which covers single runs
    too, lines of MIN_TOKENS or more that of the whole line and one for each run, and shorter ones that of the whole
    line. Where every token of a short line has a digit no word names a template, so the digits count. Lines without
    tokens reach none.
    """
    n = F.size(tokens)

    def leaf(variable: tuple[int, ...]) -> Column:
        kept = [hashed[0], *[hashed[i + 1] for i in range(fields) if i not in variable]]
        return F.xxhash64(*[F.lit(i) for i in variable], n, *kept)

    whole = F.xxhash64(F.lit(-1), n, tokens)
    short = F.when(F.exists(tokens, lambda t: t != "<*>"), whole).otherwise(
        F.xxhash64(F.lit(-2), F.split(F.btrim(line, F.lit(" \t\x0b\f\r")), r"[ \t\x0B\f\r]+"))
    )
    single, pairs = ([leaf(v) for v in combinations(range(fields), size)] for size in (1, 2))
    return (
        F.when(F.element_at(tokens, 1) == "", F.array().cast("array<bigint>"))
        .when(n < MIN_TOKENS, F.array(short))
        .when(n < MIN_PAIR_TOKENS, F.array(whole, *single))
        .otherwise(F.array(*pairs))
    )


def _row_keys(text: Column) -> list[Column]:
    # The text stands beside doc_id, which may be null or repeated.
    return [F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("_doc"), F.xxhash64(text).alias("_text_key")]


def dropped_lines(docs: DataFrame, leading: int = LEADING, fields: int = FIELDS) -> DataFrame:
    """_doc, _text_key and _dropped, the places (from 0) of the lines to drop, for documents that lose any."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(*_row_keys(text), F.posexplode(F.split(text, "\n")).alias("_place", "_line"))
    # Projections of their own, so that a line is parsed, and a run hashed, once and not for every use.
    tokens = lines.select("_doc", "_text_key", "_place", "_line", parsed(F.col("_line")).alias("_tokens"))
    tokens = tokens.withColumn("_runs", runs(F.col("_tokens"), leading, fields))
    found = leaves(F.col("_tokens"), F.col("_line"), F.col("_runs"), fields)
    tokens = tokens.select("_doc", "_text_key", "_place", F.explode(found).alias("_leaf"))
    # Read twice below: the leaves of a line are a few longs, and finding them is most of the work.
    tokens = materialise(tokens, "leaves")
    spread = tokens.groupBy("_leaf").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
    recurring = spread.filter("_first < _last").select("_leaf", "_first")
    drops = tokens.join(recurring, "_leaf").filter("_doc > _first").select("_doc", "_text_key", "_place").distinct()
    return drops.groupBy("_doc", "_text_key").agg(F.sort_array(F.collect_list("_place")).alias("_dropped"))


def line_deduplicated(docs: DataFrame, leading: int = LEADING, fields: int = FIELDS) -> DataFrame:
    """The documents with all their columns, the text without the dropped lines, and n_lines and n_dropped behind.

    A null text stays null and has one line, as an empty one. Lines without tokens always stay, and so does a line that
    recurs only inside its document. Rows of one doc_id are one document; rows without a doc_id are one document too,
    after all others. Equal rows come out equal. Other columns are passed on, but for columns named n_lines and
    n_dropped, which are replaced.
    """
    docs, back = with_plain_names(docs)
    dropped = dropped_lines(docs, leading, fields)
    # Flags for the places up to the last dropped one: (not dropped ..., dropped) for each of them, end to end.
    before = F.concat(F.array(F.lit(-1)), F.slice("_dropped", F.lit(1), F.size("_dropped") - 1))
    runs = F.zip_with(
        "_dropped", before, lambda d, b: F.concat(F.array_repeat(F.lit(False), d - b - 1), F.array(F.lit(True)))
    )
    flags = dropped.select(
        "_doc", "_text_key", F.flatten(runs).alias("_flags"), F.size("_dropped").cast("long").alias("_n_dropped")
    )
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    keyed = docs.select(*columns, *_row_keys(F.coalesce(F.col("text"), F.lit(""))))
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.get("_flags", i), F.lit(False))), "\n")
    return back(keyed.join(flags, ["_doc", "_text_key"], "left").select(
        *[F.when(F.col("_flags").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c)
          for c in columns],
        F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.coalesce("_n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    ))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_deduplicated(table(spark, folder, "documents", "doc_id", "text"))


_WHITE = r"[ \t\x0B\f\r]"
_WORD = r"[^ \t\x0B\f\r]"
_CUT = f"CAST(floor((n - {LEADING}) * {{}} / {FIELDS}) AS INTEGER) + {LEADING}"


def _leaf_sql(variable: tuple[int, ...], where: str) -> str:
    runs = [f"w[1:{LEADING}]", *[f"w[{_CUT.format(i)} + 1:{_CUT.format(i + 1)}]" for i in range(FIELDS) if i not in variable]]
    said = " || chr(10) || ".join(f"coalesce(list_aggregate({r}, 'string_agg', ' '), '')" for r in runs)
    return f"SELECT doc_id, place, '{variable} ' || n || chr(10) || {said} AS leaf FROM parsed WHERE {where}"


_LEAVES = [
    *[_leaf_sql((i,), f"n >= {MIN_TOKENS} AND n < {MIN_PAIR_TOKENS}") for i in range(FIELDS)],
    *[_leaf_sql(pair, f"n >= {MIN_PAIR_TOKENS}") for pair in combinations(range(FIELDS), 2)],
]

ORACLE = f"""
WITH numbered AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), single AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM numbered
), words AS (
  SELECT doc_id, place, [x for x in
           regexp_split_to_array(regexp_replace(line, '{_WORD}*[0-9]{_WORD}*', '<*>', 'g'), '{_WHITE}+')
           if x <> ''] AS w,
         [x for x in regexp_split_to_array(line, '{_WHITE}+') if x <> ''] AS raw
  FROM single
), parsed AS (
  SELECT doc_id, place, w, raw, len(w) AS n, len([x for x in w if x <> '<*>']) AS named FROM words WHERE len(w) >= 1
), leaves AS (
  SELECT doc_id, place, '-1 ' || list_aggregate(w, 'string_agg', ' ') AS leaf FROM parsed
  WHERE n < {MIN_PAIR_TOKENS} AND (n >= {MIN_TOKENS} OR named > 0)
  UNION ALL SELECT doc_id, place, '-2 ' || list_aggregate(raw, 'string_agg', ' ') FROM parsed
  WHERE n < {MIN_TOKENS} AND named = 0
  UNION ALL {" UNION ALL ".join(_LEAVES)}
), first AS (
  SELECT leaf, min(doc_id) AS first FROM leaves GROUP BY leaf HAVING min(doc_id) < max(doc_id)
), dropped AS (
  SELECT DISTINCT leaves.doc_id, place FROM leaves JOIN first USING (leaf) WHERE leaves.doc_id > first.first
), kept AS (
  SELECT single.doc_id, string_agg(line, chr(10) ORDER BY single.place) AS text
  FROM single ANTI JOIN dropped ON single.doc_id = dropped.doc_id AND single.place = dropped.place
  GROUP BY single.doc_id
), lost AS (
  SELECT doc_id, count(*) AS n FROM dropped GROUP BY doc_id
)
SELECT numbered.doc_id, CASE WHEN lost.n IS NULL THEN numbered.text ELSE coalesce(kept.text, '') END AS text,
       CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_dropped
FROM numbered LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

QUERIES = {"op10_line_dedup": op10_line_dedup}
ORACLES = {"op10_line_dedup": ORACLE}
