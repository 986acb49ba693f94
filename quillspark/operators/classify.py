"""Rule decisions over term matches, and the matrices that combine an article's decision with its chunks'.

A decision is a struct (decision, include_score, exclude_score, include_matches, exclude_matches, review_reason). The rules are
one CASE chain over sums of weights, so a scan decides a row without leaving the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark import vocab
from quillspark.functions.terms import TermSet, names_of, score_of, union_of
from quillspark.functions.text import given, normalize, normalize_dense

DECISION = ("decision", "include_score", "exclude_score", "include_matches", "exclude_matches", "review_reason")


@dataclass(frozen=True)
class Rules:
    """Vocabularies of the word-term classifier."""

    disease: TermSet = vocab.EN_DISEASE
    treatment: TermSet = vocab.EN_TREATMENT
    human: TermSet = vocab.EN_HUMAN
    exclude: TermSet = vocab.EN_EXCLUDE
    strong: frozenset = vocab.EN_STRONG
    heavy: frozenset = vocab.EN_ANIMAL_HEAVY
    noise: frozenset = vocab.EN_CHUNK_NOISE


FIXTURE = Rules(vocab.FIX_DISEASE, vocab.FIX_TREATMENT, vocab.FIX_HUMAN, vocab.FIX_EXCLUDE, vocab.FIX_STRONG, vocab.FIX_HEAVY, vocab.FIX_NOISE)

#: (condition, decision, reason) in order; i and x are the include and exclude sums, t and h those of treatment and human terms.
_EN_CHAIN = (
    ("heavy AND i < 12", "exclude", "animal/veterinary mastitis signal dominates"),
    ("x >= 10 AND i < x + 4", "exclude", "exclude terms dominate target evidence"),
    ("strong AND t >= 2 AND i >= x + 3", "include", ""),
    ("strong AND h >= 2 AND i >= x + 4", "include", ""),
    ("i >= 6 AND x = 0", "review", "related but lacks strong disease-treatment evidence"),
    ("i > 0", "review", "mixed or weak target evidence"),
    ("TRUE", "exclude", "no target mastitis evidence"),
)
#: As above; a, l and o are the sums of animal, lactational and other terms, d that of disease terms, condition whether the condition is named at all.
_ZH_CHAIN = (
    ("a > 0", "exclude", "动物或兽医乳腺炎证据明确"),
    ("l >= 6 AND NOT strong", "exclude", "仅见哺乳期或产褥期乳腺炎证据"),
    ("o >= 7 AND NOT strong", "exclude", "肿瘤或实验模型信号占主导"),
    ("strong AND i >= x + 6", "include", ""),
    ("d >= 6", "review", "目标疾病相关，但题名或正文证据不足以自动进入 strict"),
    ("t >= 3 AND h >= 2 AND condition", "review", "人类乳腺炎治疗相关，但未明确非哺乳期亚型"),
    ("TRUE", "exclude", "没有明确的目标非哺乳期乳腺炎证据"),
)


def chain_sql(chain: Sequence[tuple[str, str, str]], pick: int) -> str:
    """The chain as SQL that both engines read: pick 1 for the decision, 2 for the reason."""
    return "CASE " + " ".join(f"WHEN {row[0]} THEN '{row[pick]}'" for row in chain) + " END"


def _decided(df: DataFrame, chain, include: Sequence[str], exclude: Sequence[str], into: str) -> DataFrame:
    names = {k: names_of(F.col(f"__{k}")) for k in (*include, *exclude)}
    summed = df.withColumns({"i": sum((score_of(F.col(f"__{k}")) for k in include), F.lit(0)), "x": sum((score_of(F.col(f"__{k}")) for k in exclude), F.lit(0))})
    return summed.withColumn(
        into,
        F.struct(
            F.expr(chain_sql(chain, 1)).alias("decision"),
            F.col("i").alias("include_score"),
            F.col("x").alias("exclude_score"),
            union_of(*(names[k] for k in include)).alias("include_matches"),
            union_of(*(names[k] for k in exclude)).alias("exclude_matches"),
            F.expr(chain_sql(chain, 2)).alias("review_reason"),
        ),
    )


def _one_of(matches: str, terms: frozenset) -> Column:
    return F.exists(F.col(matches), lambda m: m["term"].isin(sorted(terms)))


def classify(df: DataFrame, text: Column, rules: Rules = Rules(), into: str = "decision") -> DataFrame:
    """df and a decision by word terms over text that is not yet normalised."""
    given_columns = df.columns
    work = df.select(F.struct(*given_columns).alias("__row"), normalize(text).alias("__t"))
    work = work.withColumns({"__disease": rules.disease.matches(F.col("__t")), "__treatment": rules.treatment.matches(F.col("__t")), "__human": rules.human.matches(F.col("__t")), "__exclude": rules.exclude.matches(F.col("__t"))})
    work = work.withColumns({"t": score_of(F.col("__treatment")), "h": score_of(F.col("__human")), "strong": _one_of("__disease", rules.strong), "heavy": _one_of("__exclude", rules.heavy)})
    return _decided(work, _EN_CHAIN, ("disease", "treatment", "human"), ("exclude",), into).select("__row.*", into)


def classify_cjk(df: DataFrame, text: Column, into: str = "decision") -> DataFrame:
    """df and a decision by substring terms."""
    sets = {"disease": vocab.ZH_DISEASE, "treatment": vocab.ZH_TREATMENT, "human": vocab.ZH_HUMAN, "animal": vocab.ZH_ANIMAL, "lactational": vocab.ZH_LACTATIONAL, "other": vocab.ZH_OTHER}
    work = df.select(F.struct(*df.columns).alias("__row"), normalize_dense(text).alias("__t"))
    work = work.withColumns({f"__{k}": s.matches(F.col("__t")) for k, s in sets.items()})
    work = work.withColumns({k[0]: score_of(F.col(f"__{k}")) for k in sets} | {"strong": F.exists("__disease", lambda m: m["weight"] >= 8), "condition": F.contains("__t", F.lit(vocab.ZH_CONDITION))})
    return _decided(work, _ZH_CHAIN, ("disease", "treatment", "human"), ("animal", "lactational", "other"), into).select("__row.*", into)


def joined_text(df: DataFrame, *columns: str) -> Column:
    """The given columns' texts with blanks between; those that df lacks are empty."""
    return F.concat_ws(" ", *(given(c) for c in columns if c in df.columns), F.lit(""))


def classify_records(df: DataFrame, rules: Rules = Rules(), into: str = "decision") -> DataFrame:
    return classify(df, joined_text(df, "title", "abstract", "journal", "keywords"), rules, into)


def classify_chunks(df: DataFrame, rules: Rules = Rules(), into: str = "decision") -> DataFrame:
    """Section and text alone count: a title tells of the article, not of this passage."""
    return classify(df, joined_text(df, "section", "text"), rules, into)


def classify_records_cjk(df: DataFrame, into: str = "decision") -> DataFrame:
    return classify_cjk(df, joined_text(df, *"title keywords abstract journal".split()), into)


def classify_chunks_cjk(df: DataFrame, into: str = "decision") -> DataFrame:
    return classify_cjk(df, joined_text(df, "section", "text"), into)


def bucket(decision: Column) -> Column:
    """strict, review or excluded."""
    return F.when(decision == "include", "strict").when(decision == "review", "review").otherwise("excluded")


def decision_columns(decision: str = "decision") -> list[Column]:
    """A decision as flat columns, lists joined, for tables that people read."""
    d = F.col(decision)
    flat = [F.array_join(d[f], "; ") if f.endswith("matches") else d[f] for f in DECISION]
    return [c.alias(f"filter_{f}") for c, f in zip(flat, DECISION)]


IDS = ("pmcid", "pmid", "doi")


def identifiers(df: DataFrame, columns: Sequence[str] = IDS, prefixed: bool = False) -> Column:
    """array<struct<prio, id>> of a row's identifiers that are not empty, normalised."""
    each = []
    for k, c in enumerate(columns):
        v = normalize(c) if c in df.columns else F.lit("")
        each.append(F.when(v != "", F.struct(F.lit(k).alias("prio"), (F.concat(F.lit(f"{c}:"), v) if prefixed else v).alias("id"))))
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def decisions_by_id(records: DataFrame, seq: str, decision: str = "decision", prefixed: bool = False) -> DataFrame:
    """(id, decision): for each identifier the decision of the last record that has it."""
    each = records.select(seq, decision, F.explode(identifiers(records, prefixed=prefixed)).alias("x")).select(seq, decision, "x.id")
    return each.groupBy("id").agg(F.max_by(decision, seq).alias(decision))


def with_article(chunks: DataFrame, decisions: DataFrame, key: Sequence[str], into: str = "article", decision: str = "decision", prefixed: bool = False) -> DataFrame:
    """chunks and the decision of the first of their identifiers (pmcid, pmid, doi) that decisions has; null if none does.

    Only (key, id) pairs are shuffled to the decisions, and one row for each key comes back. key: columns that name a chunk.
    """
    each = chunks.select(*key, F.explode(identifiers(chunks, prefixed=prefixed)).alias("x")).select(*key, "x.prio", "x.id")
    found = each.join(decisions.select("id", F.col(decision).alias(into)), "id").groupBy(*key).agg(F.min_by(into, "prio").alias(into))
    return chunks.join(found, list(key), "left")


def route_chunks(chunks: DataFrame, rules: Rules = Rules(), article: str = "article", chunk: str = "decision") -> DataFrame:
    """Adds bucket, level and the decision that is shown, by the article's and the chunk's decisions."""
    a, c = F.col(article)["decision"], F.col(chunk)["decision"]
    noisy = F.exists(F.col(chunk)["exclude_matches"], lambda t: t.isin(sorted(rules.noise)))
    kept = F.coalesce(a == "include", F.lit(False))
    gone = F.coalesce(a == "exclude", F.lit(False))
    level = (
        F.when(gone, "article")
        .when(kept & noisy, "chunk_noise_review")
        .when(kept & (c == "include"), "article_and_chunk")
        .when(~kept & (c == "include"), "chunk_without_included_article")
        .otherwise("chunk")
    )
    where = F.when(gone, "excluded").when(kept & ~noisy & (c == "include"), "strict").when(kept | c.isin("include", "review"), "review").otherwise("excluded")
    return chunks.withColumns({"bucket": where, "filter_level": level, "shown": F.when(gone, F.col(article)).otherwise(F.col(chunk))})


def route_chunks_cjk(chunks: DataFrame, article: str = "article", chunk: str = "decision", text: Column | None = None) -> DataFrame:
    """As :func:`route_chunks`: chunks of kept articles stay whatever they say themselves, unless they speak of animals."""
    a = F.col(article)["decision"]
    animals = vocab.ZH_ANIMAL.found(normalize_dense(joined_text(chunks, "section", "text") if text is None else text))
    work = chunks.withColumn("__animals", animals)
    animal = F.size("__animals") > 0
    own = F.col(chunk)
    told = F.struct(
        F.lit("review").alias("decision"), own["include_score"].alias("include_score"), own["exclude_score"].alias("exclude_score"), own["include_matches"].alias("include_matches"),
        F.col("__animals").alias("exclude_matches"), F.lit("目标文章内部出现动物语境，需人工复核").alias("review_reason"),
    )
    kept = a == "include"
    level = F.when(a.isNull(), "missing_registry").when(a == "exclude", "article").when(a == "review", "article_review").when(kept & animal, "chunk_animal_review").otherwise("article")
    where = F.when(a.isNull() | (a == "review") | (kept & animal), "review").when(a == "exclude", "excluded").otherwise("strict")
    shown = F.when(a.isNull() | (a == "review"), own).when(kept & animal, told).otherwise(F.col(article))
    return work.withColumns({"bucket": where, "filter_level": level, "shown": shown}).drop("__animals")


def bucket_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def numbered_last(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Of each key the row of greatest seq; rows whose key is blank go."""
    return df.where(given(key) != "").withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(seq)))).where("__n = 1").drop("__n")
