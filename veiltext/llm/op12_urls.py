"""Verdicts on urls by rules and, beyond them, by a tree of path templates for each host. Built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work

#: Levels of a tree; the last one takes the whole rest of a longer path as one segment.
LEVELS = 16
#: A segment stays as it is if it stands in so many urls of its host and in this share of those with such a level.
LEAST, SHARE = 5, 0.05
#: Weight of the node above in a node's purity, in labelled urls.
SMOOTHING = 2.0
#: A template is rejected beyond this purity.
REJECT = 0.5
#: Standard deviations that the chi-square of similar branches may lie above its mean.
SIGMAS = 2.33
#: Kinds of segments: empty, numbers, hexadecimal and other words, each with a file extension or without.
KINDS = ("", "{n}", "{n}.*", "{hex}", "{hex}.*", "{word}", "{word}.*")

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; else empty."""
    rest = url.substr(F.locate("://", url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(url.contains("://"), host).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    rest = url.substr(F.locate("://", url) + 3, F.length(url))
    return F.when(url.contains("://"), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (null: none) and its verdict; of equally long ones that of the longer host, then by text.

    A rule is a host, a slash and the beginning of a path. It fits the host and its subdomains.
    """
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[1])):
        name, start = rule[: rule.index("/")].lower(), rule[rule.index("/") :]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def segments_of(path: Column) -> Column:
    """The segments of a path, none for an empty one; at most LEVELS, the last of which may hold slashes."""
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path.substr(F.lit(2), F.length(path)), "/", LEVELS))


def kind_of(segment: Column) -> Column:
    """The place in KINDS of what a segment looks like."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}\z", "")
    plain = F.when(stem.rlike(r"\A[0-9]+\z"), 1).when(stem.rlike(r"\A(?=.*[0-9])[0-9A-Fa-f-]{8,}\z"), 3).otherwise(5)
    return F.when(segment == "", 0).otherwise(plain + (stem != segment).cast("int"))


def shaped(urls: DataFrame, work: Work) -> DataFrame:
    """host, path, n, blocked, labelled and steps: for each segment its place, its node and its kind.

    A node is = and the segment where that is frequent at its level of the host's tree, else * and its kind. Counts are
    summed before they are dealt; the two joins are with tables of one row for each key, so that Spark can split hot keys.
    """
    each = urls.select("host", "path", "n", "blocked", "labelled", F.posexplode(segments_of(F.col("path"))).alias("pos", "seg"))
    counts = work.save(each.groupBy("host", "pos", "seg").agg(F.sum("n").alias("c")))
    totals = counts.groupBy("host", "pos").agg(F.sum("c").alias("total"))
    frequent = counts.where(F.col("c") >= LEAST).join(totals, ["host", "pos"]).where(F.col("c") >= SHARE * F.col("total"))
    frequent = work.save(frequent.select("host", "pos", "seg", F.lit(True).alias("stays")))
    kind = kind_of(F.col("seg"))
    node = F.when(F.col("stays"), F.concat(F.lit("="), "seg")).otherwise(F.concat(F.lit("*"), F.get(F.array(*map(F.lit, KINDS)), kind)))
    step = F.struct("pos", node.alias("node"), kind.alias("kind"))
    named = each.join(frequent, ["host", "pos", "seg"], "left").groupBy("host", "path").agg(
        *(F.first(c).alias(c) for c in ("n", "blocked", "labelled")), F.array_sort(F.collect_list(step)).alias("steps")
    )
    short = urls.where("path = ''").select("host", "path", "n", "blocked", "labelled", F.array().cast(named.schema["steps"].dataType).alias("steps"))
    return work.save(named.union(short))


def _alike(a: Column, b: Column) -> Column:
    """Whether two branches may be the same: what follows them, by a chi-square of two samples, and their labels if both have some."""
    shares = F.zip_with(a["next"], b["next"], lambda x, y: F.when(x + y > 0, F.pow(x * F.sqrt(b["n"] / a["n"]) - y * F.sqrt(a["n"] / b["n"]), F.lit(2)) / (x + y)).otherwise(0.0))
    chi = F.aggregate(shares, F.lit(0.0), lambda t, x: t + x)
    free = F.size(F.filter(F.zip_with(a["next"], b["next"], lambda x, y: x + y), lambda x: x > 0)) - 1
    share = lambda x: F.try_divide(x["blocked"], x["labelled"])
    pooled = F.try_divide(a["blocked"] + b["blocked"], a["labelled"] + b["labelled"])
    chance = pooled * (1 - pooled) * (F.try_divide(F.lit(1), a["labelled"]) + F.try_divide(F.lit(1), b["labelled"]))
    same_labels = F.coalesce(F.pow(share(a) - share(b), F.lit(2)) <= SIGMAS * SIGMAS * chance, F.lit(True))
    return (chi <= free + SIGMAS * F.sqrt(2.0 * free)) & same_labels


def merged(kinds: DataFrame) -> DataFrame:
    """host, above, node, leader, name: to which branch each child of a node belongs, and what that branch is called.

    kinds: host, steps, n, blocked, labelled. A node has at most 1 / SHARE frequent children and one of each kind. From
    the largest on, each child joins the first branch that is like it (its rows summed with those that joined before), or
    begins one.
    """
    size = F.size("steps")
    nodes = F.transform("steps", lambda s: s["node"])
    levels = kinds.where(size > 0).select("host", "n", "blocked", "labelled", "steps", F.explode(F.sequence(F.lit(1), size)).alias("k"))
    after = F.when(F.col("k") < size, F.get("steps", F.col("k"))["kind"] + 1).otherwise(0)
    here = levels.select("host", F.slice(nodes, F.lit(1), F.col("k") - 1).alias("above"), F.get(nodes, F.col("k") - 1).alias("node"), "n", "blocked", "labelled", after.alias("after"))
    profile = F.array(*(F.sum(F.when(F.col("after") == j, F.col("n")).otherwise(0)) for j in range(len(KINDS) + 1)))
    branch = here.groupBy("host", "above", "node").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"), profile.alias("next"))
    child = F.struct((-F.col("n")).alias("by"), "node", "n", "blocked", "labelled", "next", F.array("node").alias("members"))
    beside = branch.groupBy("host", "above").agg(F.array_sort(F.collect_list(child)).alias("children"))
    kind = branch.select(child.alias("c")).schema["c"].dataType.simpleString()

    def joined(c: Column, x: Column) -> Column:
        sums = [(c[f] + x[f]).alias(f) for f in ("n", "blocked", "labelled")]
        return F.struct(c["by"].alias("by"), c["node"].alias("node"), *sums, F.zip_with(c["next"], x["next"], lambda a, b: a + b).alias("next"), F.concat(c["members"], x["members"]).alias("members"))

    def step(done: Column, x: Column) -> Column:
        first = F.array_position(F.transform(done, lambda c: _alike(c, x)), F.lit(True))
        return F.when(first == 0, F.concat(done, F.array(x))).otherwise(F.transform(done, lambda c, i: F.when(i == first - 1, joined(c, x)).otherwise(c)))

    branches = beside.select("host", "above", F.explode(F.aggregate("children", F.array().cast(f"array<{kind}>"), step)).alias("b"))
    shown = F.transform(F.array_sort("b.members"), lambda m: m.substr(F.lit(2), F.length(m)))
    name = F.when(F.size(shown) == 1, shown[0]).otherwise(F.concat(F.lit("("), F.array_join(shown, "|"), F.lit(")")))
    return branches.select("host", "above", F.col("b.node").alias("leader"), name.alias("name"), F.explode("b.members").alias("node"))


def purities(table: DataFrame, work: Work, smoothing: float) -> DataFrame:
    """host, steps, template, purity of the different step lists of shaped(): the smoothed share of blocked among labelled urls.

    Each node of the merged tree leans on the one above it with the weight `smoothing`, a host on all labelled urls.
    """
    kinds = work.save(table.groupBy("host", "steps").agg(*(F.sum(c).alias(c) for c in ("n", "blocked", "labelled"))))
    nodes = F.transform("steps", lambda s: s["node"])
    levels = kinds.select("host", "steps", F.posexplode(nodes).alias("k", "node")).withColumn("above", F.slice(F.transform("steps", lambda s: s["node"]), F.lit(1), F.col("k")))
    found = levels.join(merged(kinds), ["host", "above", "node"]).groupBy("host", "steps")
    found = found.agg(F.array_sort(F.collect_list(F.struct("k", "leader", "name"))).alias("way"))
    ways = kinds.join(found, ["host", "steps"], "left").select("host", "steps", "blocked", "labelled", F.coalesce("way", F.array().cast(found.schema["way"].dataType)).alias("way"))
    ways = work.save(ways)
    leaders = F.transform("way", lambda w: w["leader"])
    every = F.sequence(F.lit(0), F.size("way"))
    prefixes = ways.select("host", "steps", "blocked", "labelled", F.explode(F.transform(every, lambda k: F.struct(k.alias("k"), F.slice(leaders, F.lit(1), k).alias("prefix")))).alias("p"))
    prefixes = prefixes.select("host", "steps", "blocked", "labelled", "p.k", "p.prefix")
    sums = prefixes.groupBy("host", "prefix").agg(F.sum("blocked").alias("bad"), F.sum("labelled").alias("known"))
    chains = prefixes.join(sums, ["host", "prefix"]).groupBy("host", "steps").agg(F.array_sort(F.collect_list(F.struct("k", "bad", "known"))).alias("chain"))
    whole = kinds.agg(F.sum("blocked").alias("bad"), F.sum("labelled").alias("known")).head()
    start = ((whole.bad or 0) + smoothing / 2) / ((whole.known or 0) + smoothing)
    purity = F.aggregate("chain", F.lit(start), lambda p, x: (x["bad"] + smoothing * p) / (x["known"] + smoothing))
    text = F.concat(F.when(F.size("way") > 0, "/").otherwise(""), F.array_join(F.transform("way", lambda w: w["name"]), "/"))
    return work.save(ways.join(chains, ["host", "steps"]).select("host", "steps", text.alias("template"), purity.alias("purity")))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", reject: float = REJECT, smoothing: float = SMOOTHING) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), template and purity of every row of pages.

    rules: (allow or block, host/path). The longest rule that fits gives the verdict and labels the url. Urls that no rule
    fits are judged by their template: per host, segments that vary are generalised, branches that are statistically alike
    are merged, and a template whose smoothed share of blocked among labelled urls is above `reject` is blocked. Segments
    are counted for each level of a host's tree, so that no level waits for the one above.

    Null url, or one without ://: host and path are empty, no rule fits, and it is judged by all labelled urls. Equal urls
    have equal verdicts; a null id is a row like others; all rows are returned. No labelled url at all: allow. No rows: none.
    Columns of any other name do not matter.
    """
    if any(v not in ("allow", "block") or "/" not in r or r.startswith("/") for v, r in rules):
        raise ValueError("rules: (allow or block, host/path)")
    work = Work(pages.sparkSession)
    url = F.coalesce(pages[url_col].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = rows.groupBy("host", "path").agg(F.count("*").alias("n"))
    labelled = F.when(verdict.isNotNull(), F.col("n")).otherwise(0)
    urls = work.save(urls.select("host", "path", "n", F.when(verdict == "block", F.col("n")).otherwise(0).alias("blocked"), labelled.alias("labelled")))
    table = shaped(urls, work)
    judged = work.save(table.join(purities(table, work, smoothing), ["host", "steps"]).select("host", "path", "template", "purity"))
    learned = F.when(F.col("purity") > reject, "block").otherwise("allow")
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "template", "purity")
