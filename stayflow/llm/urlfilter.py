"""URL filters: host and path rules, then a blocked Bloom filter of listed canonical
URLs whose possible hits go to an exact hash join.

The filter is a DataFrame of at most ``blocks`` rows of eight 64-bit words (one block
per hash residue), so its broadcast size is a parameter and not a matter of the data:
2 ** 15 blocks are 2.4 MB.  A longer list raises the rate of false positives, which
the exact join removes, never the size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import BLOOM_BLOCKS, lower_ascii, maybe_listed

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Query parameters that do not name another page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without trailing slashes, sorted query without tracking
    parameters; no scheme, no fragment.  Null without ``://``."""
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    rest = F.array_join(F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    body = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", ""),
                    F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, body)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, listed: DataFrame, url_col: str = "url", listed_col: str = "url",
                rules: Sequence[tuple[str, str, str]] = RULES, blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """``pages`` plus ``_host``, ``_path``, ``_canonical``, ``_rule``, ``_listed`` and ``_verdict``.

    A rule decides where one fits; else a page is blocked if its canonical URL is in
    ``listed`` (canonicalised too, repeated and null entries allowed).  Null URLs and
    URLs without ``://`` have empty host and path and are never listed.  Rows repeat as
    given.  Hits are joined as distinct URLs, combined before the shuffle, so a URL that
    fills a third of the pages is one row of the exact join; the marks return to the
    pages in a join whose hot keys AQE splits.
    """
    cols = [F.col(f"`{c}`") for c in pages.columns
            if c not in {"_host", "_path", "_canonical", "_rule", "_listed", "_verdict", "_block", "_url", "_hit", "_named"}]
    u = F.col(f"`{url_col}`")
    base = pages.select(*cols, host_of(u).alias("_host"), path_of(u).alias("_path"), canonical(u).alias("_canonical"))
    base = base.withColumn("_named", rule_of(F.col("_host"), F.col("_path"), rules))
    entries = listed.select(canonical(F.col(f"`{listed_col}`")).alias("_url")).filter("_url IS NOT NULL").distinct()
    # possible hits of the undecided pages: every bit of the URL is set in its block
    open_urls = base.filter("_named IS NULL AND _canonical IS NOT NULL").select("_canonical").distinct()
    possible = maybe_listed(open_urls, ["_canonical"], entries, ["_url"], blocks)
    hits = possible.join(entries, possible["_canonical"] == entries["_url"], "left_semi").select(
        F.col("_canonical").alias("_hit"))
    out = base.join(hits, (base["_canonical"] == hits["_hit"]) & base["_named"].isNull(), "left")
    return out.select(
        *cols, "_host", "_path", "_canonical", F.col("_named.rule").alias("_rule"), F.col("_hit").isNotNull().alias("_listed"),
        F.coalesce(F.col("_named.verdict"), F.when(F.col("_hit").isNotNull(), "block").otherwise("allow")).alias("_verdict"))


def oracle_sql(listed: str, rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """DuckDB CTEs ending in ``judged``; ``listed`` is a query of one column ``url``."""
    def parts(src):
        return f"""SELECT *, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path,
  array_to_string(list_sort(list_filter(string_split(coalesce(regexp_extract(url, '://[^?#]*\\?([^#]*)', 1), ''), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))), '&') AS rest FROM {src}"""
    canon = """CASE WHEN contains(url, '://') THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN rest <> '' THEN '?' || rest ELSE '' END END"""
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v)
            for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"
    return f"""lst AS (SELECT DISTINCT {canon} AS c FROM ({parts(f'({listed}) AS l')})),
judged AS (SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN c IN (SELECT c FROM lst WHERE c IS NOT NULL) THEN 'block' ELSE 'allow' END) AS verdict
  FROM (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled, {canon} AS c FROM ({parts('pages')})))"""
