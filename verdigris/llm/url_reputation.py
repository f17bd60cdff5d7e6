"""URL filter: rules first, then the empirical-Bayes reputation of the host.

Outcomes (good or not) of labelled pages are counted by host, registered domain and public
suffix. Each level is a beta-binomial: the prior of a suffix is centred on the mean of all
outcomes, that of a domain on its suffix, that of a host on its domain. A level's prior
strength is estimated from all its groups by the method of moments, so hosts with few
labels are drawn to their domain and hosts with many keep their own rate. A page is allowed
if the lower bound of its host's posterior, ``z`` standard deviations below the mean, is at
least ``least``. A host, domain or suffix without labels has its parent's mean.

Only DataFrame functions run here. A host with a third of all pages is one counted row
before any shuffle; pages meet host verdicts in a join of two scans, which adaptive
execution can split.

Defined cases: a null URL, or one without ``://``, has empty host and path and is judged as
a host of its own with the empty suffix; a null outcome is no outcome; repeated labels count each; addresses
in digits are their own domain with suffix ``ip``; without any outcome the mean is 1/2.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.llm.common import unused, without
from verdigris.session import materialize

# The rules of the contract, as (verdict, host and path).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
MOST_RULES = 1_000  # rules become one expression
# Public suffixes of two labels.
TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp",
    "ne.jp", "co.kr", "com.br", "com.mx", "com.ar", "com.cn", "com.tw", "co.in", "co.za", "com.tr",
)
LEAST = 0.5
Z = 1.645
TIGHTEST, LOOSEST = 1e-4, 0.5  # limits of the correlation within a group


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


# The number a path ends in, with or without file ending or slash: the document it shows.
NUMBER = r"/([0-9]{1,18})(\.html)?/?\z"


def shown_document(url: Column) -> Column:
    """Id of the document that a page shows, by the number at the end of its path; null without one."""
    found = F.regexp_extract(split_url(url)[1], NUMBER, 1)
    return F.when(found != "", found).try_cast("long")


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, prefix = rule.partition("/")
        inside = (host == name) | host.endswith("." + name)
        fit = inside & path.startswith(slash + prefix) if slash else inside
        fits.append(F.when(fit, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    none = F.lit(None).cast("struct<rule: string, verdict: string>")
    return F.coalesce(*fits, none)


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host, without user, port and final dot."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), "\\.$", "")
    labels = F.split(bare, "\\.")
    last_two = F.substring_index(bare, ".", -2)
    two = last_two.isin(*TWO_LABEL_SUFFIXES)
    address = bare.rlike("^[0-9.]+$") | bare.startswith("[")
    suffix = F.when(address, F.lit("ip")).when(two, last_two).otherwise(F.element_at(labels, -1))
    domain = (
        F.when(address, bare).when(two, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))
    )
    return domain, suffix


def _strength(groups: DataFrame, parent: str) -> float:
    """Prior strength of a level, from groups with n, good and the parent's mean."""
    p = F.col(parent)
    spread = p * (1 - p)
    row = groups.filter("n > 0").agg(
        F.sum(F.pow(F.col("good") - F.col("n") * p, 2) - F.col("n") * spread).alias("excess"),
        F.sum(F.col("n") * (F.col("n") - 1) * spread).alias("pairs"),
    ).first()
    alike = row["excess"] / row["pairs"] if row["pairs"] else 0.0
    alike = min(max(alike, TIGHTEST), LOOSEST)
    return 1 / alike - 1


def _level(groups: DataFrame, parent: str, name: str) -> DataFrame:
    """Posterior ``name_a``, ``name_b`` and mean ``name`` of each group."""
    strength = F.lit(_strength(groups, parent))
    a = strength * F.col(parent) + F.col("good")
    b = strength * (1 - F.col(parent)) + F.col("n") - F.col("good")
    return groups.select("*", a.alias(name + "_a"), b.alias(name + "_b"), (a / (a + b)).alias(name))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """``hosts`` (host, n, good), one row for each host, with posterior mean and lower bound."""
    domain, suffix = domain_and_suffix(F.col("host"))
    named = materialize(hosts.select("host", "n", "good", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = named.agg(*sums).first()
    mean = (total["good"] or 0) / total["n"] if total["n"] else 0.5
    suffixes = named.groupBy("suffix").agg(*sums).withColumn("all", F.lit(mean))
    suffixes = materialize(_level(suffixes, "all", "suffix_mean").select("suffix", "suffix_mean"), "suffixes")
    domains = named.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix")
    domains = materialize(_level(domains, "suffix_mean", "domain_mean").select("domain", "suffix", "domain_mean"), "domains")
    placed = named.join(domains, ["suffix", "domain"])
    judged = _level(materialize(placed, "placed"), "domain_mean", "reputation")
    a, b = F.col("reputation_a"), F.col("reputation_b")
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return judged.select("host", "domain", "suffix", "n", "good", "reputation", deviation.alias("deviation"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    url: str = "url",
    key: str = "page_id",
    rules: Sequence[tuple[str, str]] = RULES,
    least: float = LEAST,
    z: float = Z,
) -> DataFrame:
    """Every page with host, path, rule, verdict, reputation and bound.

    ``outcomes`` is (key, good), good being 0 or 1; a page may have several.
    """
    outputs = ("host", "path", "rule", "verdict", "reputation", "bound")
    host, path = split_url(F.col(url))
    h, p, m, k = unused(pages, "_host", "_path", "_match", "_key")
    parsed = pages.withColumns({h: host, p: path})
    parsed = parsed.withColumn(m, match_rule(F.col(h), F.col(p), rules))
    labels = outcomes.select(F.col(key).alias(k), F.col("good").cast("long").alias("good")).filter("good is not null")
    labels = labels.groupBy(k).agg(F.count("good").alias("n"), F.sum("good").alias("good"))
    counted = (
        parsed.select(F.col(h).alias("host"), F.col(key).alias("own"))
        .join(labels, F.col("own") == F.col(k), "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    )
    known = host_reputation(counted)
    bound = F.col("reputation") - z * F.col("deviation")
    known = materialize(known.select(F.col("host").alias(k), F.struct("reputation", bound.alias("bound")).alias("_r")), "reputation")
    joined = parsed.join(known, F.col(h) == F.col(k))
    own = F.when(F.col("_r.bound") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return joined.select(
        *without(pages, outputs),
        F.col(h).alias("host"),
        F.col(p).alias("path"),
        F.col(m)["rule"].alias("rule"),
        F.coalesce(F.col(m)["verdict"], own).alias("verdict"),
        F.col("_r.reputation").alias("reputation"),
        F.col("_r.bound").alias("bound"),
    )


def filter_sql() -> str:
    """DuckDB SQL for page_id, host, path, rule and verdict.

    The outcome of a page is labels.quality of the document that its url shows.
    """
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    cases = []
    for verdict, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        name, slash, prefix = rule.partition("/")
        cases.append((f"(host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '{slash}{prefix}')", rule, verdict))
    rule = "case " + " ".join(f"when {c} then '{r}'" for c, r, _ in cases) + " end"
    verdict = "case " + " ".join(f"when {c} then '{v}'" for c, _, v in cases) + " end"

    def strength(source: str, parent: str) -> str:
        return f"""(select 1 / least(greatest(case when sum(n * (n - 1) * {parent} * (1 - {parent})) > 0 then
          sum((good - n * {parent}) ** 2 - n * {parent} * (1 - {parent})) / sum(n * (n - 1) * {parent} * (1 - {parent}))
          else 0 end, {TIGHTEST}), {LOOSEST}) - 1 from {source} where n > 0)"""

    return f"""
with cut as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
split as (select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{lower}') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
shown as (select *, try_cast(nullif(regexp_extract(path, '{NUMBER}', 1), '') as bigint) as document from split),
marks as (select doc_id, count(quality) as n, sum(quality) as good from labels where quality is not null group by doc_id),
hosts as (select host, coalesce(sum(n), 0)::double as n, coalesce(sum(good), 0)::double as good,
  regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\\.$', '') as bare
  from shown left join marks on document = doc_id group by host),
parts as (select *, string_split(bare, '.') as l from hosts),
named as (select host, n, good,
  case when regexp_matches(bare, '^[0-9.]+$') or starts_with(bare, '[') then 'ip'
    when array_to_string(l[-2:], '.') in ({two}) then array_to_string(l[-2:], '.') else l[-1] end as suffix,
  case when regexp_matches(bare, '^[0-9.]+$') or starts_with(bare, '[') then bare
    when array_to_string(l[-2:], '.') in ({two}) then array_to_string(l[-3:], '.') else array_to_string(l[-2:], '.') end as domain
  from parts),
suffixes as (select suffix, sum(n) as n, sum(good) as good,
  (select case when sum(n) > 0 then sum(good) / sum(n) else 0.5 end from named) as m from named group by suffix),
suffix_post as (select suffix, (s * m + good) / (s + n) as sm from (select *, {strength("suffixes", "m")} as s from suffixes)),
domains as (select domain, suffix, sm, sum(n) as n, sum(good) as good from named join suffix_post using (suffix) group by all),
domain_post as (select domain, suffix, (s * sm + good) / (s + n) as dm from (select *, {strength("domains", "sm")} as s from domains)),
placed as (select host, n, good, dm from named join domain_post using (domain, suffix)),
beta as (select host, s * dm + good as a, s * (1 - dm) + n - good as b from (select *, {strength("placed", "dm")} as s from placed)),
bounds as (select host, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from beta)
select page_id, host, path, {rule} as rule,
  coalesce({verdict}, case when bound >= {LEAST} then 'allow' else 'block' end) as verdict
from split join bounds using (host)"""
