"""Fill-in-middle: texts cut into prefix, middle and suffix by one regular expression with counted quantifiers.

``regexp_count`` gives the number of units (code points) of a text. A row's own pattern, a possessive group of the
first cut's count and one of the count between the cuts, captures prefix, middle and suffix in one match, and its
replacement puts them in the order of the row's form: ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix,
middle), each behind its marker. ``plain`` texts stay as they are. Possessive counts loop without backtracking or
recursion, so a text of any length takes one linear match; to count, whole blocks of ``BLOCK`` units are matched
first, so that a very long text makes no list of its units.

Cuts and forms come from the hash of the id, so they are the same in every run. Null and empty texts are plain and
give an empty output; texts that hold a marker are plain. A null id hashes as empty text. Equal rows give equal
rows, extra columns are kept by ``transform``, ties cannot arise, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are rearranged, and of 100 of these so many suffix first.
RATE = 90
SPM_RATE = 20
BLOCK = 64
_OUTPUT = rf"(?s)\A(?:{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}|{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE})(.*+)\z"


def count_units(text: Column) -> Column:
    """Code points of ``text``: its whole blocks and what is left after them."""
    blocks = F.regexp_count(text, F.lit(f"(?s).{{{BLOCK}}}"))
    rest = F.regexp_extract(text, rf"(?s)\A(?:.{{{BLOCK}}})*+(.*+)\z", 1)
    return (F.lit(BLOCK) * blocks.cast("long") + F.regexp_count(rest, F.lit("(?s)."))).cast("long")


def _draws(doc_id: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of an id."""
    name = F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _cut(parts: DataFrame, source: str, output: str) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars and the output of the text in column ``source``."""
    h1, h2, h3, h4 = _draws(F.col("doc_id"))
    n = f"{output}_n"
    counted = parts.withColumn(n, count_units(F.col(source)))
    first, second = h1 % (F.col(n) + 1), h2 % (F.col(n) + 1)
    marked = F.col(source).contains(PREFIX) | F.col(source).contains(SUFFIX) | F.col(source).contains(MIDDLE)
    plain = (F.col(n) == 0) | marked | (h3 % 100 >= RATE)
    shaped = counted.withColumns(
        {
            f"{output}_form": F.when(plain, "plain").when(h4 % 100 < SPM_RATE, "spm").otherwise("psm"),
            f"{output}_prefix": F.when(~plain, F.least(first, second)),
            f"{output}_middle": F.when(~plain, F.greatest(first, second) - F.least(first, second)),
        }
    )
    form = F.col(f"{output}_form")
    pattern = F.concat(
        F.lit(r"(?s)\A(.{"), F.col(f"{output}_prefix").cast("string"), F.lit(r"}+)(.{"),
        F.col(f"{output}_middle").cast("string"), F.lit(r"}+)(.*+)\z"),
    )
    order = F.when(form == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    moved = F.regexp_replace(F.col(source), pattern, order)
    return shaped.withColumn(output, F.when(form == "plain", F.col(source)).otherwise(moved))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    No marker occurs in a rearranged text, and none can begin inside another, so the first ones are the inserted ones.
    """
    return F.when(form == "plain", output).otherwise(F.regexp_replace(output, _OUTPUT, "$1$4$5$2$3"))


def transform(docs: DataFrame, text: str = "text", form: str = "fim_form") -> DataFrame:
    """``docs`` with ``text`` rearranged and one more column, its form; needs ``doc_id``."""
    source, out = "__stumpline_source", "__stumpline_fim"
    shaped = _cut(docs.withColumn(source, F.coalesce(F.col(text), F.lit(""))), source, out)
    columns = [F.col(out).alias(c) if c == text else F.col(c) for c in docs.columns]
    return shaped.select(*columns, F.col(f"{out}_form").alias(form))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the digests of output and restored text."""
    cut = _cut(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("source")), "source", "out")
    return cut.select(
        "doc_id", F.col("out_n").alias("n"), F.col("out_form").alias("form"),
        F.col("out_prefix").alias("prefix_chars"), F.col("out_middle").alias("middle_chars"),
        F.sha2("out", 256).alias("output_sha256"),
        F.sha2(restore(F.col("out"), F.col("out_form")), 256).alias("restored_sha256"),
    )


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                     THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
