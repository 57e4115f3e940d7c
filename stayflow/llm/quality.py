"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0).  Expectation-maximisation over
the table of vote patterns (at most 3 ** rules rows, whatever the corpus size)
estimates per rule how often it votes each way, or abstains, on good and on bad
documents; the posterior probability of "good" replaces all-must-pass filtering.  Everything is
DataFrame / SQL: text statistics are in-row array expressions without a shuffle, the
only exchange is the pattern count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import SEPARATORS, staged, words

WINDOW = 5
#: Distinct words are counted in blocks of so many words, so their share does not fall with a text's length.
BLOCK = 200
ITERATIONS = 12
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_block_distinct", "line_chars",
         "n_dup_chars", "n_upper", "n_exclaim")


@dataclass(frozen=True)
class Rule:
    """``good`` and ``bad`` are SQL conditions over the statistics; neither: abstain."""
    name: str
    good: str
    bad: str

    def vote(self) -> str:
        return f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END"


#: All rules but the last speak only against a document, each about one kind of junk; the last speaks for plain
#: prose.  Each is a share of the text, so clean texts of any length are judged alike.
RULES = (
    Rule("word_length", "1 = 0", "word_chars > 20 * n_words"),
    Rule("symbols", "1 = 0", "100 * n_symbols > 10 * n_words"),
    Rule("dup_lines", "1 = 0", "100 * n_dup_chars > 45 * line_chars"),
    Rule("repeats", "1 = 0", "100 * n_repeat_words > 20 * n_words"),
    Rule("vocabulary", "1 = 0", "100 * n_block_distinct < 10 * n_words"),
    Rule("upper_case", "1 = 0", "100 * n_upper > 50 * word_chars"),
    Rule("exclaim", "1 = 0", "100 * n_exclaim > 10 * n_words"),
    Rule("prose", "word_chars BETWEEN 2 * n_words AND 12 * n_words AND 100 * n_symbols <= 2 * n_words AND 100 * n_dup_chars <= 45 * line_chars "
         "AND 100 * n_repeat_words <= 20 * n_words AND 100 * n_block_distinct >= 20 * n_words AND 100 * n_upper <= 20 * word_chars "
         "AND 100 * n_exclaim <= 2 * n_words", "1 = 0"),
)
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
#: Where the estimation starts: share of good documents, then the shares of bad and good
#: votes that a rule gives good documents, and those that it gives bad ones.
START = (0.85, (0.005, 0.6), (0.25, 0.05))


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_<stat>`` for each of STATS (long); null text counts as empty.

    A word is repeated if one of the 5-word windows that cover it occurs twice or more
    in the text.  Windows are compared by 64-bit hash; texts whose windows are all
    distinct (most) never sort them.  ``n_block_distinct`` sums the distinct words of each
    BLOCK words; ``line_chars`` and ``n_dup_chars`` are the characters of lines with a word,
    and of those that repeat an earlier one.
    """
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    df = docs.withColumn("_w", words(F.col(f"`{text_col}`"))).withColumn("_n_words", F.size("_w").cast("long"))
    df = df.withColumn("_win", F.expr(
        f"CASE WHEN _n_words >= {WINDOW} THEN transform(sequence(0, size(_w) - {WINDOW}), i -> xxhash64("
        + ", ".join(f"_w[i + {k}]" for k in range(WINDOW)) + ")) ELSE cast(array() AS array<bigint>) END"))
    # sorted (window, position) pairs, only for texts with a repeated window
    df = df.withColumn("_srt", F.expr(
        "CASE WHEN size(array_distinct(_win)) < size(_win) THEN sort_array(transform(_win, (h, i) -> struct(h, i))) END"))
    df = df.withColumn("_at", F.expr(
        "CASE WHEN _srt IS NOT NULL THEN sort_array(filter(transform(sequence(0, size(_srt) - 1), k -> CASE WHEN "
        "(k > 0 AND _srt[k].h = get(_srt, k - 1).h) OR (k + 1 < size(_srt) AND _srt[k].h = get(_srt, k + 1).h) "
        "THEN _srt[k].i END), x -> x IS NOT NULL)) ELSE cast(array() AS array<int>) END"))
    covered = F.expr(
        "aggregate(_at, named_struct('c', 0L, 'e', 0), (s, p) -> named_struct("
        f"'c', s.c + p + {WINDOW} - greatest(p, s.e), 'e', p + {WINDOW}), s -> s.c)")

    def count_of(chars: str):
        return F.length(t) - F.length(F.translate(t, chars, ""))

    return df.select(
        *[F.col(f"`{c}`") for c in docs.columns], "_n_words",
        F.length(F.translate(t, SEPARATORS, "")).cast("long").alias("_word_chars"),
        count_of(SYMBOLS).cast("long").alias("_n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("_n_dup_lines"),
        covered.cast("long").alias("_n_repeat_words"),
        F.expr(f"CASE WHEN _n_words > 0 THEN aggregate(sequence(0, cast((_n_words - 1) div {BLOCK} AS int)), 0L, "
               f"(s, i) -> s + size(array_distinct(slice(_w, i * {BLOCK} + 1, {BLOCK})))) ELSE 0L END").alias("_n_block_distinct"),
        F.length(F.array_join(lines, "")).cast("long").alias("_line_chars"),
        (F.length(F.array_join(lines, "")) - F.length(F.array_join(F.array_distinct(lines), ""))).cast("long").alias("_n_dup_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long").alias("_n_upper"),
        count_of("!").cast("long").alias("_n_exclaim"))


def parameters(rules: Sequence[Rule]) -> dict[str, float]:
    """``pi``, and per rule j the shares of bad and good votes on good (``gm``, ``gp``) and bad documents (``bm``, ``bp``)."""
    return {"pi": START[0]} | {f"{c}{s}{j}": START[1 + (c == "b")][s == "p"]
                               for j in range(len(rules)) for c in "gb" for s in "mp"}


def posterior_sql(rules: Sequence[Rule], value: dict[str, str]) -> str:
    """SQL of P(good | votes v0, v1, ...); ``value`` has the SQL of each parameter."""
    def term(c, j):
        m, p = value[f"{c}m{j}"], value[f"{c}p{j}"]
        return f"CASE v{j} WHEN 1 THEN ln({p}) WHEN -1 THEN ln({m}) ELSE ln(1 - {m} - {p}) END"
    good, bad = (" + ".join(term(c, j) for j in range(len(rules))) for c in "gb")
    return f"1 / (1 + exp((ln(1 - {value['pi']}) + {bad}) - (ln({value['pi']}) + {good})))"


def maximise_sql(rules: Sequence[Rule]) -> list[str]:
    """SQL aggregates over (v0.., n, q) that re-estimate the parameters (add-one smoothed)."""
    out = ["(coalesce(sum(n * q), 0) + 1) / (coalesce(sum(n), 0) + 2) AS pi"]
    for j in range(len(rules)):
        for c, mass in (("g", "n * q"), ("b", "n * (1 - q)")):
            for s, vote in (("m", -1), ("p", 1)):
                out.append(f"(coalesce(sum(CASE WHEN v{j} = {vote} THEN {mass} END), 0) + 1)"
                           f" / (coalesce(sum({mass}), 0) + 3) AS {c}{s}{j}")
    return out


def literals(p: dict[str, float]) -> dict[str, str]:
    return {name: f"{x!r}D" for name, x in p.items()}


def estimate(patterns: DataFrame, rules: Sequence[Rule] = RULES, iterations: int = ITERATIONS) -> dict[str, float]:
    """EM on the vote patterns (``v0``.., ``n``); one row of parameters returns per iteration."""
    p = parameters(rules)
    for _ in range(iterations):
        q = posterior_sql(rules, literals(p))
        p = patterns.withColumn("q", F.expr(q)).agg(*[F.expr(x) for x in maximise_sql(rules)]).first().asDict()
    return p


def quality_rules(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES,
                  iterations: int = ITERATIONS, threshold: float = 0.5, keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) plus the ``_`` statistics, ``_base_failed``,
    ``_p_good`` and ``_kept``.

    Null or empty text: no words, fails the base rule.  An empty table gives an empty
    result.  Repeated rows are judged each on their own and alike.  Columns of ``docs``
    keep their names; added ones start with an underscore and replace a column so named.
    """
    added = [f"_{s}" for s in STATS]
    kept_cols = [c for c in (keep if keep is not None else docs.columns) if c not in {*added, "_base_failed", "_p_good", "_kept"}]
    # inside, the columns of docs have names of their own, so none can clash with those made here
    own = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*kept_cols, text_col]))}
    df = text_stats(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), own[text_col])
    votes = df.select(*[own[c] for c in kept_cols], *added, *[
        F.expr(_underscored(r.vote())).cast("int").alias(f"v{j}") for j, r in enumerate(rules)])
    votes = staged(votes, "quality")  # read twice: for the pattern counts and for the verdicts
    patterns = votes.groupBy(*[f"v{j}" for j in range(len(rules))]).agg(F.count(F.lit(1)).alias("n"))
    p = estimate(patterns.coalesce(1).checkpoint(), rules, iterations)
    return (votes.withColumn("_base_failed", F.expr(_underscored(BASE_FAILED)))
            .withColumn("_p_good", F.round(F.expr(posterior_sql(rules, literals(p))), 6))
            .withColumn("_kept", ~F.col("_base_failed") & (F.col("_p_good") >= threshold))
            .select(*[F.col(own[c]).alias(c) for c in kept_cols], *added, "_base_failed", "_p_good", "_kept"))


def _underscored(sql: str) -> str:
    for s in sorted(STATS, key=len, reverse=True):
        sql = sql.replace(s, f"_{s}")
    return sql


def kept_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that the rules reject (same columns, whatever their names)."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    out = quality_rules(docs.toDF(*names), text_col=names[docs.columns.index(text_col)], **options).filter("_kept")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def oracle_sql(rules: Sequence[Rule] = RULES, iterations: int = ITERATIONS, source: str = "documents") -> tuple[str, str]:
    """DuckDB SQL with the same statistics, votes and estimation: (CTEs, final FROM table).

    The final table ``judged`` has doc_id, the statistics, base_failed, p_good, kept.
    """
    sep = "[\\x20\\x09-\\x0D]"
    votes = ", ".join(f"{r.vote()} AS v{j}" for j, r in enumerate(rules))
    k = range(len(rules))
    ctes = [
        f"src AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {source})",
        f"tok AS MATERIALIZED (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '{sep}+'), lambda x: x <> '') AS w, "
        "list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM src)",
        f"win AS (SELECT rid, i, w[i:i + {WINDOW - 1}] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM tok))",
        "rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1)",
        f"cov AS (SELECT rid, count(DISTINCT i + d) AS c FROM rep, range({WINDOW}) AS r(d) GROUP BY rid)",
        "stats AS MATERIALIZED (SELECT rid, doc_id, len(w)::BIGINT AS n_words, "
        f"length(regexp_replace(t, '{sep}+', '', 'g'))::BIGINT AS word_chars, "
        "length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, "
        "(len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, "
        "coalesce(c, 0)::BIGINT AS n_repeat_words, "
        f"coalesce(list_sum(list_transform(range(0, len(w), {BLOCK}), lambda i: len(list_distinct(w[i + 1:i + {BLOCK}])))), 0)::BIGINT "
        "AS n_block_distinct, length(array_to_string(l, ''))::BIGINT AS line_chars, "
        "(length(array_to_string(l, '')) - length(array_to_string(list_distinct(l), '')))::BIGINT AS n_dup_chars, "
        "(length(t) - length(regexp_replace(t, '\\p{Lu}+', '', 'g')))::BIGINT AS n_upper, "
        "(length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaim "
        "FROM tok LEFT JOIN cov USING (rid))",
        f"votes AS MATERIALIZED (SELECT *, {votes} FROM stats)",
        f"pat AS MATERIALIZED (SELECT {', '.join(f'v{j}' for j in k)}, count(*) AS n FROM votes GROUP BY ALL)",
        "par0 AS (SELECT " + ", ".join(f"{x!r}::DOUBLE AS {name}" for name, x in parameters(rules).items()) + ")",
    ]
    q = posterior_sql(rules, {name: name for name in parameters(rules)})
    for it in range(iterations):
        ctes.append(f"par{it + 1} AS MATERIALIZED (SELECT {', '.join(maximise_sql(rules))} FROM "
                    f"(SELECT {', '.join(f'v{j}' for j in k)}, n, {q} AS q FROM pat, par{it}))")
    ctes.append(f"judged AS (SELECT rid, doc_id, {', '.join(STATS)}, ({BASE_FAILED}) AS base_failed, p_good, "
                f"NOT ({BASE_FAILED}) AND p_good >= 0.5 AS kept FROM "
                f"(SELECT *, round({q}, 6) AS p_good FROM votes, par{iterations}))")
    return ",\n".join(ctes), "judged"
