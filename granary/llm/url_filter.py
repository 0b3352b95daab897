"""URL filter: longest-prefix host/path rules, and for urls without a rule a verdict on the host from link-graph
propagation (personalised PageRank from trusted hosts, reversed distrust from blocked ones).

Defined cases: a url that is null or has no "://" has empty host and path and fits no rule; hosts reached by neither
flow are allowed; repeated pages keep one row each, and the links of each count; pages without html have no links; an empty table gives no rows.
Columns of the input other than page_id, url and html are not read, so their names cannot clash.
DataFrame functions only: no Python runs on executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values of the contract, in its order.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
#: Rounds go on until no more than SETTLED of all trust and distrust moves in one, ROUNDS at most (0.85 ** 60 is below 0.0001).
DAMPING, ROUNDS, SETTLED, CUT_EVERY = 0.85, 60, 1e-4, 5
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"\A[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, else null. The rules are a parameter, not data."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, *, damping: float = DAMPING, rounds: int = ROUNDS, ratio: float = 1.0
) -> DataFrame:
    """pages: page_id, url, html. Returns page_id, host, path, rule, verdict, trust, distrust (of the host).

    A page's rule decides; else its host is blocked if its distrust exceeds ratio times its trust."""
    host, path = split_url(F.col("url"))
    judged = cut(
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
        .select("page_id", "host", "path", "fit.rule", "fit.verdict"),
        "pages",
    )
    scores = host_scores(judged, host_links(pages), damping, rounds)
    blocked = F.coalesce(F.col("distrust") > ratio * F.col("trust"), F.lit(False))
    return judged.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def host_links(pages: DataFrame) -> DataFrame:
    """Links between different hosts (source, target, n), added up before and after the shuffle."""
    source, _ = split_url(F.col("url"))
    return (
        pages.select(source.alias("source"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("target"))
        .select("source", ascii_lower(F.col("target")).alias("target"))
        .where("source <> '' and source <> target")
        .groupBy("source", "target")
        .agg(F.count("*").alias("n"))
    )


def host_scores(judged: DataFrame, links: DataFrame, damping: float, rounds: int) -> DataFrame:
    """host, trust, distrust; each adds up to one. Trust flows along links from hosts by their share of allowed pages; distrust flows
    against them from hosts by their share of blocked pages. Links are at most one row a pair of hosts. What flows to a host without
    links on goes back to the seeds, in their shares: that makes all scores larger by one factor, so it is done at the end, by dividing by their sum."""
    seeds = cut(
        judged.where("verdict is not null and host <> ''")
        .groupBy("host")
        .agg(F.count_if(F.col("verdict") == "allow").alias("t"), F.count_if(F.col("verdict") == "block").alias("d")),
        "seeds",
    )
    total = seeds.agg(F.sum("t"), F.sum("d")).first()
    seeds = seeds.select(
        "host",
        (F.col("t") * (1 - damping) / float(total[0] or 1)).alias("t"),
        (F.col("d") * (1 - damping) / float(total[1] or 1)).alias("d"),
    )
    out = links.groupBy("source").agg(F.sum("n").alias("out"))
    into = links.groupBy("target").agg(F.sum("n").alias("into"))
    links = cut(
        links.join(out, "source")
        .join(into, "target")
        .select("source", "target", (damping * F.col("n") / F.col("out")).alias("along"), (damping * F.col("n") / F.col("into")).alias("against")),
        "links",
    )
    state = last = seeds
    if not links.isEmpty():
        for k in range(rounds):
            along = links.join(state, links.source == state.host).select(
                F.col("target").alias("host"), (F.col("t") * F.col("along")).alias("t"), F.lit(0.0).alias("d")
            )
            against = links.join(state, links.target == state.host).select(
                F.col("source").alias("host"), F.lit(0.0).alias("t"), (F.col("d") * F.col("against")).alias("d")
            )
            state = seeds.unionByName(along).unionByName(against).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
            if k % CUT_EVERY == CUT_EVERY - 1:
                state = cut(state, "scores")
                if _moved(last, state) <= SETTLED:
                    break
            last = state
    total = state.agg(F.sum("t"), F.sum("d")).first()
    return state.select("host", (F.col("t") / float(total[0] or 1)).alias("trust"), (F.col("d") / float(total[1] or 1)).alias("distrust"))


def _moved(before: DataFrame, after: DataFrame) -> float:
    """The greater share of all trust or distrust by which the last round changed the scores."""
    both = before.select("host", (-F.col("t")).alias("t"), (-F.col("d")).alias("d")).unionByName(after).groupBy("host")
    change = both.agg(F.abs(F.sum("t")).alias("t"), F.abs(F.sum("d")).alias("d")).agg(F.sum("t"), F.sum("d")).first()
    total = after.agg(F.sum("t"), F.sum("d")).first()
    return max((x or 0) / (y or 1) for x, y in zip(change, total))


def oracle(rules: tuple[Rule, ...] = RULES, damping: float = DAMPING, rounds: int = ROUNDS) -> str:
    """The same in SQL, a table for each round."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    cases = lambda what: (
        "case "
        + " ".join(
            f"when (host = {quoted(r.host)} or ends_with(host, {quoted('.' + r.host)})) and starts_with(path, {quoted(r.path)}) then {quoted(what(r))}"
            for r in sorted(rules, key=lambda r: -len(r.text))
        )
        + " end"
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lower.format("regexp_extract(rest, '^[^/?#]*')")
    steps = "".join(
        f""", s{k + 1} as materialized (select host, sum(t) t, sum(d) d from (
            select * from s0 union all select target, t * along, 0.0 from l join s{k} s on s.host = l.source
            union all select source, 0.0, d * against from l join s{k} s on s.host = l.target) group by host)"""
        for k in range(rounds)
    )
    return f"""
    with u as (select page_id, html, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
    p as (select page_id, html, coalesce({host}, '') host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') path from u),
    j as (select page_id, html, host, path, {cases(lambda r: r.text)} rule, {cases(lambda r: r.verdict)} verdict from p),
    s0 as (select host, {1 - damping!r}::double * sum((verdict = 'allow')::int) / greatest(1, (select count(*) from j where host <> '' and verdict = 'allow')) t,
        {1 - damping!r}::double * sum((verdict = 'block')::int) / greatest(1, (select count(*) from j where host <> '' and verdict = 'block')) d
        from j where verdict is not null and host <> '' group by host),
    e as (select host source, {lower.format("unnest(regexp_extract_all(html, " + quoted(LINK) + ", 1))")} target from j where host <> ''),
    g as (select source, target, count(*) n from e where source <> target group by all),
    l as (select source, target, {damping!r}::double * n / sum(n) over (partition by source) along,
        {damping!r}::double * n / sum(n) over (partition by target) against from g)
    {steps}
    select page_id, j.host, path, rule, coalesce(verdict, case when d * (select sum(t) from s{rounds}) > t * (select sum(d) from s{rounds}) then 'block' else 'allow' end) verdict
    from j left join s{rounds} s on s.host = j.host"""
