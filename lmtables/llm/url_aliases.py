"""URL rules whose decisions reach every alias of a page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lmtables.llm.components import connected_components
from lmtables.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """One name for spellings that differ in scheme, host case or fragment only; null where there is no host part."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(url_host(url), url_path(url), query))


PARTS = {"node": url_node, "host": url_host, "path": url_path}


def named(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """Adds columns that later steps refer to without computing them again at each place (a generator ends inlining)."""
    values = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select(*keep, F.inline(F.array(values)))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules such as ``("block", "example.com/de/")`` as a table: rule, action, rule_host, rule_path."""
    rows = [(rule, action, rule.split("/")[0].lower(), rule[len(rule.split("/")[0]) :]) for action, rule in rules]
    return spark.createDataFrame(rows, "rule string, action string, rule_host string, rule_path string")


def _attribute(tag: Column, name: str) -> Column:
    parts = [F.nullif(F.regexp_extract(tag, rf"(?is)[\s\"']{name}{VALUE}", k), F.lit("")) for k in (1, 2, 3)]
    return F.coalesce(*parts)


REFERENCE = r"(?i)&(?:#x([0-9a-f]{1,6})|#([0-9]{1,7})|(amp|lt|gt|quot|apos));?"
# The characters of the references by name that a url can hold.
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def decoded(text: Column) -> Column:
    """Character references, by number or one of the names above, as their characters; others stay as they are."""
    named_ = F.create_map(*(F.lit(x) for pair in NAMED.items() for x in pair))
    ends = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))

    def character(reference: Column) -> Column:
        hexadecimal, number, name = (F.nullif(F.regexp_extract(reference, REFERENCE, k), F.lit("")) for k in (1, 2, 3))
        code = F.coalesce(F.conv(hexadecimal, 16, 10), number).cast("int")
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        usable = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(code.isNull(), F.try_element_at(named_, F.lower(name))).when(usable, letter).otherwise(F.lit("\ufffd"))

    between = F.split(text, REFERENCE, -1)
    joined = F.zip_with(between, F.transform(ends, character), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(joined, "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """The path with its segments ``.`` and ``..`` carried out; ``..`` at the root is left out."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    # The segment before the first slash is empty and stays at the bottom.
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.least(F.size(done), F.lit(1)))))
        .otherwise(F.concat(done, F.array(part))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.contains("/."), F.array_join(closed, "/")).otherwise(path)


def resolved(href: Column, base: Column) -> Column:
    """An absolute url for a reference on a page whose base is the absolute url ``base``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    origin = F.concat(scheme, F.lit("://"), F.regexp_extract(base, r"(?s)^.*?://([^/?#]*)", 1))
    path = url_path(base)
    folder = F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), "[^/]*$", "")
    whole = (
        F.when(href.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(origin, path, href))
        .otherwise(F.concat(origin, folder, href))
    )
    pieces = [F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$", k) for k in (1, 2, 3)]
    return F.concat(pieces[0], without_dots(pieces[1]), pieces[2])


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Canonical links and immediate redirects that pages declare: ``src``, ``dst`` (absolute urls).

    Targets have their character references decoded and are resolved against the page's first ``<base href>``, else
    against its url; segments ``.`` and ``..`` are carried out. Comments and what stands inside of scripts, styles,
    templates, titles and text areas declare nothing. Pages without url or html have none; a target without a host
    (``javascript:`` and so on), an empty one and one that is a fragment only are no links.
    """
    text = F.lower(F.col(html))
    page = pages.select(F.col(url).alias("src"), F.col(html).alias("body")).where(
        F.col(url).contains("://") & (text.contains("canonical") | text.contains("http-equiv"))
    )
    silent = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|noscript|textarea|title)\b.*?(?:</\1\s*>|\z)"
    tags = F.regexp_extract_all(
        F.regexp_replace("body", silent, " "), F.lit(r"""(?is)<(?:link|meta|base)\s(?:[^>"']|"[^"]*"|'[^']*')*>"""), F.lit(0)
    )
    tagged = named(page, "src", tags=tags)
    bases = F.filter("tags", lambda tag: tag.rlike(r"(?is)^<base") & _attribute(tag, "href").isNotNull())
    href = F.trim(decoded(_attribute(F.get(bases, F.lit(0)), "href")))
    tag = named(tagged, "src", "tags", base=F.coalesce(resolved(href, F.col("src")), F.col("src")))
    tag = tag.select("src", "base", F.explode("tags").alias("tag"))
    content = _attribute(F.col("tag"), "content")
    target = F.when(
        F.col("tag").rlike(r"(?is)^<link") & _attribute(F.col("tag"), "rel").rlike(r"(?i)(^|\s)canonical(\s|$)"),
        _attribute(F.col("tag"), "href"),
    ).when(
        F.col("tag").rlike(r"(?is)^<meta") & _attribute(F.col("tag"), "http-equiv").rlike(r"(?i)^\s*refresh\s*$"),
        F.regexp_extract(content, r"(?is)^\s*\d[\d.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"']*)", 1),
    )
    found = named(tag.where(target.isNotNull()), "src", "base", href=F.trim(decoded(target)))
    href = F.col("href")
    usable = (href != "") & ~href.startswith("#") & ~href.rlike(r"(?i)^(javascript|mailto|data|tel|about):")
    return named(found.where(usable), "src", dst=resolved(href, F.col("base")))


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule that fits each distinct (host, path): adds ``rule`` and ``action``, rows without a rule go.

    A host is looked up by its last labels, as many as the longest rule has, so a row becomes a bounded number of
    keys. Of rules of one length an allowing one wins, then the one first in order.
    """
    deepest = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    suffixes = [
        F.when(F.size(labels) >= k, F.array_join(F.slice(labels, -k, k), ".")) for k in range(1, max(deepest, 1) + 1)
    ]
    keyed = places.where("host <> ''").select("host", "path", F.explode(F.array_compact(F.array(*suffixes))).alias("rule_host"))
    fits = keyed.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = F.struct(-F.length("rule"), F.when(F.col("action") == "allow", 0).otherwise(1), F.col("rule"))
    chosen = F.min_by(F.struct("rule", "action"), best)
    return fits.groupBy("host", "path").agg(chosen.alias("won")).select("host", "path", "won.rule", "won.action")


def judge_urls(urls: DataFrame, rules: DataFrame, links: DataFrame, *, key: str, url: str = "url") -> DataFrame:
    """Decides for every row of ``urls``: key, ``host``, ``path``, ``rule``, ``verdict`` (allow or block).

    A url with a rule of its own gets that rule's action. Otherwise the decisions of all urls that redirects and
    canonical links (``links``: src, dst) connect it to count: one allowed alias allows it, else one blocked alias
    blocks it. What no decision reaches is allowed. Null urls and urls without ``://`` have empty host and path, no
    rule and no alias. Repeated rows stay; other columns are not read, so their names cannot clash.
    """
    row = urls.select(F.col(key), F.col(url).alias("_url")).select(
        key,
        url_host(F.col("_url")).alias("host"),
        url_path(F.col("_url")).alias("path"),
        url_node(F.col("_url")).alias("_node"),
    )
    ruled = match_rules(row.select("host", "path").distinct(), rules)
    judged = row.join(ruled, ["host", "path"], "left")
    ends = {f"{c}_{n}": part(F.col(c)) for c in ("src", "dst") for n, part in PARTS.items()}
    edges = stage(named(links, **ends).where("src_node <> dst_node"), "alias-edges")
    alias = F.lit(None).cast("string")
    if not edges.isEmpty():
        members = connected_components(edges, "src_node", "dst_node")
        from_, to = (edges.select(*(F.col(f"{c}_{n}").alias(n) for n in PARTS)) for c in ("src", "dst"))
        places = from_.unionByName(to).distinct()
        own = places.join(match_rules(places.select("host", "path").distinct(), rules), ["host", "path"])
        spread = (
            own.join(members, own["node"] == members["node"])
            .groupBy("component")
            .agg(F.min("action").alias("_alias"))  # "allow" comes before "block"
        )
        reached = members.join(spread, "component").select(F.col("node").alias("_node"), "_alias")
        judged, alias = judged.join(reached, "_node", "left"), F.col("_alias")
    return judged.select(key, "host", "path", "rule", F.coalesce("action", alias, F.lit("allow")).alias("verdict"))

