"""URL filter: path rules first, then an empirical-Bayes reputation of the host.

Outcomes of labelled pages (bad or not) are counted per host, registered domain and suffix. Each
level's rate is shrunk towards its parent's through a beta-binomial prior whose strength is
estimated by moments from the spread between the level's own members. A host is blocked when the
lower posterior bound of its share of bad pages exceeds a threshold, so one bad page of an unknown
host blocks nothing, while a host without labels inherits its domain's rate with full uncertainty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.common import ascii_lower, stored, table

# The rules of the contract, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Suffixes of two labels, below which names are registered.
TWO_LABEL_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "co.in", "co.za"]

MAX_BAD_SHARE = 0.5
Z = 1.645  # one-sided 95 % bound
WEAKEST, STRONGEST = 1.0, 1000.0


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def longest_rule(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits the host or a parent of it; else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name, start in sorted(rules if rules is not None else RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def strength(level: DataFrame) -> float:
    """Prior strength by moments: rows (n, bad, m), m the parent's rate. One row reaches the driver.

    Without any spread beyond chance the strongest prior holds, without labels the weakest.
    """
    p = F.col("bad") / F.col("n")
    x = level.filter("n > 0").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum(F.col("n") * (p - F.col("m")) * (p - F.col("m"))).alias("spread"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("chance"),
    ).first()
    if not x.k or not x.chance:
        return WEAKEST
    room, noise = x.n - x.n2 / x.n, (x.k - 1) * x.chance / x.n
    if room <= 0 or x.spread <= noise:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, x.chance / x.n * room / (x.spread - noise) - 1))


def _level(hosts: DataFrame, key: str, parent: str | None) -> DataFrame:
    keys = [key] + ([parent] if parent else [])
    return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Rows (host, n, bad, mean, low): one per host of `outcomes` (host, bad long or null).

    `bad` is 1 or 0 for a labelled page and null for one without label. low is the lower posterior
    bound of the host's share of bad pages. Counts are summed before the shuffle, so a host with a
    third of all pages costs no more than another.
    """
    hosts = stored(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                   .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = (total.bad or 0) / total.n if total.n else 0.0

    def shrunk(level: DataFrame) -> DataFrame:
        s = strength(level)
        return level.withColumn("mean", (F.col("bad") + s * F.col("m")) / (F.col("n") + s)).withColumn("s", F.lit(s))

    suffixes = shrunk(_level(hosts, "suffix", None).withColumn("m", F.lit(float(mean))))
    suffixes = stored(suffixes.select("suffix", F.col("mean").alias("m")), "suffixes")
    domains = shrunk(stored(_level(hosts, "domain", "suffix").join(suffixes, "suffix"), "domains-raw"))
    domains = stored(domains.select("domain", "suffix", F.col("mean").alias("m")), "domains")
    rated = shrunk(stored(hosts.join(domains, ["domain", "suffix"]), "hosts-raw"))
    a = F.col("bad") + F.col("s") * F.col("m")
    b = F.col("n") - F.col("bad") + F.col("s") * (1 - F.col("m"))
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return rated.select("host", "n", "bad", "mean", (F.col("mean") - Z * sd).alias("low"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=None, max_bad_share: float = MAX_BAD_SHARE) -> DataFrame:
    """pages (page_id, url) and outcomes (page_id, bad 0 or 1): rows page_id, host, path, rule, verdict, low.

    A null url, or one without ://, has an empty host and path, fits no rule and is judged as host
    "". Pages without outcome count in no rate. Several outcomes of one page: bad if any is. Repeated
    pages are judged alike; an empty table gives an empty result.
    """
    known = outcomes.groupBy(F.col("page_id").alias("_page")).agg(F.max(F.col("bad").cast("long")).alias("bad"))
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    split = stored(split, "urls")
    labelled = split.join(known, F.col("page_id") == F.col("_page"), "left").select("host", "bad")
    rated = stored(host_reputation(labelled), "reputation").select("host", "low")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("low") > max_bad_share, "block").otherwise("allow")
    return split.join(rated, "host").select("page_id", "host", "path", rule.alias("rule"),
                                            F.coalesce(verdict, own).alias("verdict"), "low")


# A page's address ends in the number of the document it shows.
DOCUMENT_NUMBER = r"/([0-9]{1,18})(?:\.html)?/?$"


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (page_id, bad): 1 if the document that the page shows is of low quality or toxic, 0 if
    it is labelled as neither; pages without number or with missing labels have none."""
    number = F.regexp_extract(path_of(F.col("url")), DOCUMENT_NUMBER, 1)
    shown = pages.select("page_id", F.when(number != "", number.cast("bigint")).alias("_doc")).filter("_doc IS NOT NULL")
    bad = (F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1)
           .when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 0))
    marks = labels.groupBy(F.col("doc_id").alias("_doc")).agg(F.max(bad).alias("bad")).filter("bad IS NOT NULL")
    return shown.join(marks, "_doc").select("page_id", "bad")


def op4_url_reputation(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels"))).drop("low")


def oracle() -> str:
    def kappa(level, name):
        return f"""{name} AS (SELECT CASE WHEN k = 0 OR chance = 0 OR chance IS NULL THEN {WEAKEST}
          WHEN n - n2 / n <= 0 OR spread <= (k - 1) * chance / n THEN {STRONGEST}
          ELSE least({STRONGEST}, greatest({WEAKEST}, chance / n * (n - n2 / n) / (spread - (k - 1) * chance / n) - 1)) END AS s
          FROM (SELECT count(*) k, sum(n)::DOUBLE n, sum(n * n)::DOUBLE n2, sum(n * (bad / n - m) * (bad / n - m)) spread,
                sum(n * m * (1 - m)) chance FROM {level} WHERE n > 0))"""

    two = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)

    def tail(k):
        return "array_to_string(list_slice(string_split(host, '.'), -%d, -1), '.')" % k

    cases, whats = "", ""
    for what, name, start in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fit = f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{start}')"
        cases += f" {fit} THEN '{name}{start}'"
        whats += f" {fit} THEN '{what}'"
    return f"""
    WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    o AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL AND toxic IS NOT NULL THEN 0 END) bad
          FROM labels GROUP BY doc_id),
    h AS (SELECT host, count(bad)::DOUBLE n, coalesce(sum(bad), 0)::DOUBLE bad,
          CASE WHEN {tail(2)} IN ({two}) THEN {tail(3)} ELSE {tail(2)} END AS domain,
          CASE WHEN {tail(2)} IN ({two}) THEN {tail(2)} ELSE {tail(1)} END AS suffix
          FROM u LEFT JOIN o ON TRY_CAST(nullif(regexp_extract(path, '{DOCUMENT_NUMBER}', 1), '') AS BIGINT) = doc_id GROUP BY host),
    s0 AS (SELECT suffix, sum(n) n, sum(bad) bad, (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) FROM h) m FROM h GROUP BY suffix),
    {kappa('s0', 'k0')},
    d0 AS (SELECT domain, d.suffix, d.n, d.bad, (s0.bad + k0.s * s0.m) / (s0.n + k0.s) m
          FROM (SELECT domain, suffix, sum(n) n, sum(bad) bad FROM h GROUP BY ALL) d JOIN s0 USING (suffix), k0),
    {kappa('d0', 'k1')},
    h0 AS (SELECT host, h.n, h.bad, (d0.bad + k1.s * d0.m) / (d0.n + k1.s) m FROM h JOIN d0 USING (domain, suffix), k1),
    {kappa('h0', 'k2')},
    r AS (SELECT host, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) low
          FROM (SELECT host, bad + s * m a, n - bad + s * (1 - m) b FROM h0, k2))
    SELECT page_id, host, path, CASE{cases} END AS "rule",
      CASE{whats} WHEN low > {MAX_BAD_SHARE} THEN 'block' ELSE 'allow' END AS verdict
    FROM u JOIN r USING (host)"""
