"""Queries over lines, pages and sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import pages as P
from quillspark.plans import query, table
from quillspark.sources.articles import html_sections

#: A source's documents are the pages of one long document.
_KEY_SQL = "regexp_replace(lower(regexp_replace({}, '\\s+', '', 'g')), '(第)?[0-9]+(页)?', '#', 'g')"


@query(f"""WITH p AS (SELECT source, doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '\\s+', '', 'g') <> '') AS l FROM documents),
e AS (SELECT source, doc_id, list_concat(l[1:2], l[greatest(len(l) - 1, 1):]) AS e FROM p),
k AS (SELECT DISTINCT source, doc_id, {_KEY_SQL.format('x')} AS key FROM (SELECT source, doc_id, unnest(e) AS x FROM e) WHERE NOT regexp_matches(x, '[。！？!?；;]')),
n AS (SELECT source, key, count(*) AS n FROM k WHERE length(key) BETWEEN 2 AND 80 GROUP BY ALL), t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source)
SELECT n.source, n.key FROM n JOIN t USING (source) WHERE pages >= 3 AND n >= greatest(3, CAST(floor(pages * 0.05 + 0.999) AS INTEGER))""")
def q19_repeated_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.repeated_margins(table(spark, sf_dir, "documents"), "source", "doc_id", "text", 0.05)


@query("""SELECT conv_id, turn, coalesce(last_value(CASE WHEN role <> 'assistant' THEN concat(role, '-', turn) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), '正文') AS section FROM conversations""")
def q20_section_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") != "assistant", F.concat_ws("-", "role", "turn")).alias("mark"))
    return P.carry_forward(turns, ["conv_id"], ["turn"], "mark", "section").select("conv_id", "turn", "section")


@query()
def q39_page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_sections(table(spark, sf_dir, "pages"), "page_id", "html", min_chars=20)
