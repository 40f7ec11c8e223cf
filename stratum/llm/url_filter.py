"""URL filters: pattern rules indexed by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum.llm.common import UPPER, LOWER, ascii_lower, table

TOKEN = "[a-z0-9]+"
_FOLD = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Rule:
    """A pattern over the url with A-Z in lower case, and the whole tokens that every match contains.

    ``tokens`` are runs of a-z and 0-9 that must stand between other characters (or the ends) of
    any url that the pattern fits; a rule without any is tried on every url. ``site`` is the
    rule's (host, path) form for host rules, else None: among those the longest that fits
    wins, and they go before the rest; of the others the first in the list that fits.
    """

    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: str | None = None


def host_rule(verdict: str, site: str) -> Rule:
    """Rule for a host with its subdomains and a path prefix, written ``host/path``."""
    host, _, path = site.partition("/")
    path = "/" + path
    # the host is that after the first separator, not of an address further on in the url
    pattern = rf"^(?:(?!://).)*://(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}"
    # a token that ends where the prefix ends may go on in the url, and then is no whole token
    whole = re.findall(TOKEN, host) + re.findall(rf"(?<![a-z0-9]){TOKEN}(?=[^a-z0-9])", path.translate(_FOLD))
    return Rule(verdict, pattern, tuple(dict.fromkeys(whole)), site)


def token_rule(verdict: str, *words: str, pattern: str | None = None) -> Rule:
    """Rule for urls that hold the whole tokens in this order, or fit ``pattern`` (which must imply them)."""
    joined = r"(?![a-z0-9]).*?(?<![a-z0-9])".join(words)
    return Rule(verdict, pattern or rf"(?<![a-z0-9]){joined}(?![a-z0-9])", words)


#: the host rules that the query's contract fixes
HOST_RULES = (host_rule("allow", "org/"), host_rule("block", "example.org/es/"),
              host_rule("block", "example.org/en/1"), host_rule("allow", "com/fr/"),
              host_rule("block", "com/de/"))

#: patterns for what no host rule covers
PATTERN_RULES = (
    token_rule("block", "utm", "source", pattern=r"[?&]utm_source=[a-z0-9_-]+"),
    token_rule("block", "ads", pattern=r"(?:://|[./])ads[./]"),
    token_rule("block", "doubleclick"), token_rule("block", "casino"), token_rule("block", "porn"),
    token_rule("block", "xxx"), token_rule("block", "torrent"), token_rule("block", "viagra"),
    token_rule("block", "login", pattern=r"/login(?:[/?#.]|$)"),
    token_rule("block", "cart", pattern=r"/cart(?:[/?#.]|$)"),
    token_rule("block", "wp", "login", pattern=r"/wp-login\.php"),
    token_rule("block", "sessionid", pattern=r"[?&;]sessionid="),
)
DEFAULT = "allow"


def host_and_path(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``df`` with the host and path of ``url`` (both empty for a null url or one without ``://``)."""
    c = F.col(url)
    at = F.instr(c, "://")
    rest = F.when(at > 0, F.substring(c, at + 3, F.length(c))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (df.withColumn(host, ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)))
            .withColumn(path, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def token_counts(urls: DataFrame, url: str, tokens: set[str]) -> dict[str, int]:
    """How many urls hold each of the rules' literal tokens, over all rows (one row per token comes back)."""
    words = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col(url)), F.lit(f"({TOKEN})"), 1))
    wanted = F.array(*[F.lit(t) for t in sorted(tokens)])
    found = urls.select(F.explode(F.array_intersect(words, wanted)).alias("token")).groupBy("token").count()
    return {r["token"]: r["count"] for r in found.collect()}


def build_index(rules: tuple[Rule, ...], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers under their rarest token (ties to the longer, then the smaller token); those without one."""
    index: dict[str, list[int]] = {}
    loose = []
    for number, rule in enumerate(rules):
        if rule.tokens:
            key = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
            index.setdefault(key, []).append(number)
        else:
            loose.append(number)
    return index, loose


def judge_urls(urls: DataFrame, rules: tuple[Rule, ...], url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``urls`` with rule (host form of the winning host rule, else null) and verdict.

    The rules are a parameter, the corpus only decides under which of its tokens each rule
    is filed. Each url is cut into tokens, the tokens fetch the rules filed under them, and
    only those run their pattern; no url is shuffled. A null url fits no rule and gets
    ``default``. Columns of ``urls`` named rule or verdict are replaced.
    """
    tokens = {t for r in rules for t in r.tokens}
    counts = token_counts(urls, url, tokens) if tokens else {}
    index, loose = build_index(rules, counts)
    compiled = [re.compile(r.pattern, re.S) for r in rules]
    fold = _FOLD
    token = re.compile(TOKEN)

    def judge(address: str | None) -> tuple[str | None, str]:
        if address is None:
            return None, default
        # paths of host rules are compared as written, so their patterns see the path unfolded
        folded = address.translate(fold)
        at = address.find("://")
        stop = len(address)
        if at >= 0:
            m = end_of_host.search(address, at + 3)
            stop = m.start() if m else len(address)
        mixed = folded[:stop] + address[stop:]
        picked = set(loose)
        for word in set(token.findall(folded)):
            picked.update(index.get(word, ()))
        best = first = None
        for number in sorted(picked):
            rule = rules[number]
            if rule.site is not None:
                if at >= 0 and compiled[number].match(mixed) and (best is None or len(rule.site) > len(rules[best].site)):
                    best = number
            elif first is None and compiled[number].search(folded):
                first = number
        if best is not None:
            return rules[best].site, rules[best].verdict
        return None, default if first is None else rules[first].verdict

    end_of_host = re.compile(r"[/?#]")

    def run(batches):
        for b in batches:
            pairs = [judge(a) for a in b.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in keep] + [pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)],
                names=[b.schema.names[i] for i in keep] + ["rule", "verdict"])

    place = urls.columns.index(url)
    keep = [i for i, c in enumerate(urls.columns) if c not in ("rule", "verdict")]
    schema = StructType([urls.schema.fields[i] for i in keep]
                        + [StructField("rule", StringType()), StructField("verdict", StringType())])
    return urls.mapInArrow(run, schema)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, HOST_RULES + PATTERN_RULES)
    return host_and_path(judged, "url", "host", "path").select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH u AS (
  SELECT page_id, url, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest,
         translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM pages),
p AS (
  SELECT page_id, low,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r AS (
  SELECT *,
    CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN regexp_matches(low, '[?&]utm_source=[a-z0-9_-]+|(://|[./])ads[./]|/login([/?#.]|$)|/cart([/?#.]|$)|/wp-login[.]php|[?&;]sessionid=')
         OR regexp_matches(low, '(^|[^a-z0-9])(doubleclick|casino|porn|xxx|torrent|viagra)([^a-z0-9]|$)')
       THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
