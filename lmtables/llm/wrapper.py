"""Main text of web pages by wrapper induction: pages of one host are aligned, and what varies shows where the content is."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lmtables.llm.page_tree import DROPPED_NAMES, REGIONS, parse, read_skeleton, skeleton_id
from lmtables.llm.url_aliases import url_host
from lmtables.session import stage

HELD_LAYOUTS = 5000
HELD_TEXTS = 200_000
SAME_TEMPLATE = 0.5
LINKS = 0.8

MODELS = 16
EXTRA = 1 << 62

LAYOUT = (
    "host string, layout string, skeleton string, pages long, low array<long>, high array<long>, chars array<long>, "
    "links array<long>, common array<array<struct<text:long,chars:long>>>"
)
ALIGNED = "host string, layout string, skeleton string, template string, nodes array<struct<id:long,above:long,key:string>>"


def _tag(key: str) -> str:
    return key.lstrip("!").split(".", 1)[0]


def _children(parents: list[int]) -> list[list[int]]:
    below: list[list[int]] = [[] for _ in parents]
    for node, above in enumerate(parents):
        if above >= 0:
            below[above].append(node)
    return below


def align(left: tuple[list[int], list[str]], right: tuple[list[int], list[str]]) -> tuple[list[int], int]:
    """Simple tree matching: for each left node its partner on the right or −1, and the number of pairs.

    Nodes pair only with equal keys, below a pair, and in order; the pairs are as many as possible. Pairs are worked
    off without recursion, from the deepest up.
    """
    a, b = _children(left[0]), _children(right[0])
    keys_a, keys_b = left[1], right[1]
    match = [-1] * len(keys_a)
    if keys_a[0] != keys_b[0]:
        return match, 0
    pairs, queue = {}, [(0, 0)]
    for i, j in queue:
        if (i, j) not in pairs:
            pairs[i, j] = 0
            queue.extend((x, y) for x in a[i] for y in b[j] if keys_a[x] == keys_b[y])

    def table(i: int, j: int) -> list[list[int]]:
        best = [[0] * (len(b[j]) + 1)]
        for x in a[i]:
            above, row = best[-1], [0]
            for m, y in enumerate(b[j]):
                row.append(max(above[m + 1], row[m], above[m] + pairs.get((x, y), 0)))
            best.append(row)
        return best

    for i, j in reversed(pairs):
        pairs[i, j] = table(i, j)[-1][-1] + 1
    stack = [(0, 0)]
    while stack:
        i, j = stack.pop()
        match[i] = j
        best, x, y = table(i, j), len(a[i]), len(b[j])
        while x and y:
            if best[x][y] == best[x - 1][y]:
                x -= 1
            elif best[x][y] == best[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                stack.append((a[i][x], b[j][y]))
    return match, pairs[0, 0]


def dropped_slots(parents: list[int], keys: list[str], mass: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Which nodes of a template are dropped by what they or elements around them are.

    A drop is lifted where the element wraps the content: where it holds more varying text (``mass``; of all text if
    none varies) than all that is not dropped, not counting what is dropped inside of it. A name of nothing but dropped
    words is lifted only where nothing else varies, a tag or role never. An article or main element is free of drops
    around it if it holds more than all that is not dropped, or is a main element, or if the drops may be lifted and no
    other article is there.
    """
    count = len(keys)
    mark = [len(k) - len(k.lstrip("!")) for k in keys]
    lifted = np.array([m == 0 for m in mark])
    freed = np.zeros(count, bool)
    by: list[list[int]] = [[] for _ in keys]  # the drops that a node stands under, itself included
    for node in range(count):
        by[node] = (by[parents[node]] if node else []) + [node] * (mark[node] > 0)

    def dropped() -> np.ndarray:
        out = np.zeros(count, bool)
        for node in range(count):
            out[node] = not lifted[node] or (node > 0 and out[parents[node]] and not freed[node])
        return out

    def size(nodes: np.ndarray) -> tuple[float, float]:
        return float(mass[nodes].sum()), float(chars[nodes].sum())

    under: dict[int, list[int]] = {}  # the text that each drop is the innermost one of
    for node in range(count):
        if by[node]:
            under.setdefault(by[node][-1], []).append(node)
    alike: dict[tuple[int, str], list[int]] = {}  # siblings of one key are lifted together
    for node in under:
        alike.setdefault((parents[node], keys[node]), []).append(node)
    waiting = []
    for nodes in alike.values():
        level = max(mark[d] for d in by[nodes[0]])
        if level < 3:
            waiting.append((size(np.array([n for d in nodes for n in under[d]])), level, nodes))
    waiting.sort(key=lambda w: w[0], reverse=True)
    gone = dropped()
    for level in (1, 2):
        for held, needs, nodes in waiting:
            rest = size(~gone)
            if needs <= level and held > rest and (needs == 1 or rest[0] == 0):
                for d in nodes:
                    lifted[by[d]] = True
                gone = dropped()

    named = [set(k.split(".")[1:]) & DROPPED_NAMES for k in keys]
    inside, whole = [-1] * count, np.zeros(count, bool)
    for node in range(count):
        inside[node] = inside[parents[node]] if node else -1
        if inside[node] < 0 and _tag(keys[node]) in REGIONS:
            inside[node] = node
    held_in: dict[int, list[int]] = {}
    for node in range(count):
        start = inside[node]
        if start >= 0:
            whole[node] = not gone[node]
            if gone[start] and not named[start] and by[node] == by[start]:
                held_in.setdefault(start, []).append(node)
    alone, rest = size(whole)[1] == 0, size(~gone)
    for around in {by[n][0] for n in held_in}:
        starts = [n for n in held_in if by[n][0] == around]
        more = size(np.array([m for n in starts for m in held_in[n]])) > rest
        for n in starts:
            marks = [mark[d] for d in by[n] if not lifted[d]]
            freed[n] = more or _tag(keys[n]) == "main" or (alone and max(marks, default=0) == 1)
    return dropped()


def content_slots(
    parents: list[int], keys: list[str], constant: np.ndarray, chars: np.ndarray, links: np.ndarray, same: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes of a template hold content, and which of them with their constant texts (``same``: characters in these).

    All of an article or main element counts but parts that are dropped by what they are. Outside of them everything
    counts that varies, or all where nothing varies, except for lists of links; how much text a part holds is not asked.
    """
    linked = links > LINKS * np.maximum(chars, 1)
    mass = np.where(linked | constant, 0, chars - same)
    dropped = dropped_slots(parents, keys, mass, np.where(linked, 0, chars))
    inside = np.array([_tag(k) in REGIONS for k in keys])
    for node in range(1, len(keys)):
        inside[node] |= inside[parents[node]]
    varies = mass[~dropped].sum() > 0
    return ~dropped & (inside | ~linked & ~(constant & varies)), inside | ~varies


def text_id(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a partition's pages of one host and one skeleton have in each slot, added up, and the texts of all of them."""
    held: dict[tuple[str, str], list] = {}
    held_texts = 0
    names = ["host", "layout", "skeleton", "pages", "low", "high", "chars", "links", "common"]
    texts_kind = pa.list_(pa.list_(pa.struct([("text", pa.int64()), ("chars", pa.int64())])))

    def emit() -> pa.RecordBatch:
        rows = []
        for (host, layout), (*values, common) in held.items():
            listed = [[{"text": t, "chars": c} for t, c in slot.items()] for slot in common]
            rows.append((host, layout, *values, listed))
        columns = list(zip(*rows))
        kinds = [pa.string()] * 3 + [pa.int64()] + [pa.list_(pa.int64())] * 4 + [texts_kind]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    for batch in batches:
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tree = parse(html)
            texts: list[list[str]] = [[] for _ in tree.keys]
            links = np.zeros(len(tree.keys), np.int64)
            for node, text, linked in tree.blocks:
                texts[tree.slot[node]].append(text)
                links[tree.slot[node]] += linked
            digest = np.array([text_id("\n".join(t)) for t in texts], np.int64)
            chars = np.array([sum(map(len, t)) for t in texts], np.int64)
            skeleton = tree.skeleton
            known = held.get((host, skeleton_id(skeleton)))
            if known is None:
                common: list[dict[int, int]] = [{} for _ in texts]
                for slot, found in zip(common, texts):
                    for text in found:
                        t = text_id(text)
                        slot[t] = slot.get(t, 0) + len(text)
                held_texts += sum(map(len, common))
                held[host, skeleton_id(skeleton)] = [skeleton, 1, digest, digest, chars, links, common]
            else:
                known[1] += 1
                known[2], known[3] = np.minimum(known[2], digest), np.maximum(known[3], digest)
                known[4], known[5] = known[4] + chars, known[5] + links
                for k, slot in enumerate(known[6]):
                    if slot:
                        now: dict[int, int] = {}
                        for text in texts[k]:
                            t = text_id(text)
                            if t in slot:
                                now[t] = now.get(t, 0) + len(text)
                        known[6][k] = {t: slot[t] + n for t, n in now.items()}
            if len(held) >= HELD_LAYOUTS or held_texts >= HELD_TEXTS:
                yield emit()
                held.clear()
                held_texts = 0
    if held:
        yield emit()


def _may_match(left: Counter, right: Counter) -> bool:
    return 2 * (left & right).total() >= SAME_TEMPLATE * (left.total() + right.total())


@lru_cache(maxsize=4)
def _distinct(models: tuple[tuple[str, str], ...]) -> list[tuple[str, tuple[list[int], list[str]], Counter]]:
    """The models, most frequent first, that match none before them."""
    kept: list[tuple[str, tuple[list[int], list[str]], Counter]] = []
    for layout, skeleton in models:
        tree = read_skeleton(skeleton)
        if _first_match(tree, kept) is None:
            kept.append((layout, tree, Counter(tree[1])))
    return kept


def _first_match(own: tuple[list[int], list[str]], models: list) -> tuple[str, tuple[list[int], list[str]], list[int]] | None:
    counted = Counter(own[1])
    for layout, model, keys in models:
        if _may_match(counted, keys):
            match, pairs = align(own, model)
            if 2 * pairs >= SAME_TEMPLATE * (len(own[1]) + len(model[1])):
                return layout, model, match
    return None


def _template_nodes(own: tuple[list[int], list[str]], model: tuple[list[int], list[str]], match: list[int]) -> list[dict]:
    """For each own node its id in the template, the id above and the key. What the model lacks is named by where it
    stands, so layouts that have the same addition share it; ids of the model are its nodes."""
    ids: list[int] = []
    seen: Counter = Counter()
    for node, partner in enumerate(match):
        if partner < 0:
            place = (ids[own[0][node]], own[1][node])
            seen[place] += 1
            partner = EXTRA | text_id(f"{place} {seen[place]}")
        ids.append(partner)
    nodes = []
    for node, partner in enumerate(match):
        above = model[0][partner] if partner >= 0 else ids[own[0][node]]
        nodes.append({"id": ids[node], "above": above, "key": own[1][node]})
    return nodes


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for row in rows.itertuples(index=False):
            own = read_skeleton(row.skeleton)
            models = tuple((m["layout"], m["skeleton"]) for m in row.models)
            found = _first_match(own, _distinct(models))
            template, nodes = (None, None) if found is None else (found[0], _template_nodes(own, *found[1:]))
            out.append((row.host, row.layout, row.skeleton, template, nodes))
        yield pd.DataFrame(out, columns=["host", "layout", "skeleton", "template", "nodes"])


def _decided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Which slots of each template are kept, and which of their texts are constant and are not."""
    for rows in batches:
        out = []
        for row in rows.itertuples(index=False):
            # Parents before children; additions after the node that they stand in, in any order.
            stats, below, order = {s["id"]: s for s in row.stats}, {}, []
            for s in row.stats:
                below.setdefault(s["above"], []).append(s["id"])
            stack = [-1]
            while stack:
                inner = sorted(below.get(stack.pop(), []), reverse=True)
                stack.extend(inner)
                order.extend(inner)
            place = {id_: k for k, id_ in enumerate(order)}
            parents = [place.get(stats[id_]["above"], -1) for id_ in order]
            keys = [stats[id_]["key"] for id_ in order]
            pages, low, high, chars, links = (
                np.array([stats[id_][name] for id_ in order], np.int64) for name in ("pages", "low", "high", "chars", "links")
            )
            common = [{c["text"]: c["chars"] for c in stats[id_]["common"]} if stats[id_]["pages"] > 1 else {} for id_ in order]
            constant = (pages > 1) & (low == high)
            same = np.where(constant, chars, [sum(c.values()) for c in common])
            keep, whole = content_slots(parents, keys, constant, chars, links, same)
            kept = [order[k] for k in np.flatnonzero(keep)]
            removed = [
                {"id": order[k], "texts": list(common[k])} for k in np.flatnonzero(keep & ~whole) if common[k]
            ]
            out.append((row.host, row.template, kept, removed))
        yield pd.DataFrame(out, columns=["host", "template", "kept", "removed"])


def _handed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The decisions on a template's slots as those on a layout's slots."""
    for rows in batches:
        keeps, constants = [], []
        for row in rows.itertuples(index=False):
            kept, removed = set(row.kept), {r["id"]: list(r["texts"]) for r in row.removed}
            keeps.append([id_ in kept for id_ in row.ids])
            constants.append([removed.get(id_, []) for id_ in row.ids])
        yield pd.DataFrame({"host": rows["host"], "layout": rows["layout"], "keep": keeps, "constant": constants})


def assign_templates(known: DataFrame) -> DataFrame:
    """The template of each layout (host, layout, skeleton, pages) and where its nodes stand there.

    The most frequent layout of a host is a model for all that match half of the nodes, the most frequent one of those
    left over is the next, until none is left. MODELS candidates of each host are looked at in one round, with the same
    outcome.
    """
    found, left = None, known
    rank = F.row_number().over(W.partitionBy("host").orderBy(F.col("pages").desc(), "layout"))
    while True:
        first = left.withColumn("rank", rank).where(F.col("rank") <= MODELS)
        models = first.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "layout", "skeleton"))).alias("models"))
        met = left.join(models, "host").select("host", "layout", "skeleton", "models")
        tried = stage(met.mapInPandas(_aligned, ALIGNED), "aligned")
        done = tried.where("template IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        rest = tried.where("template IS NULL").select("host", "layout")
        if rest.isEmpty():
            return found
        left = stage(left.join(rest, ["host", "layout"], "left_semi"), "left")


def induce(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """Learns the wrappers of all hosts: ``host``, ``layout``, and per slot of the layout ``keep`` and ``constant``, the
    texts of it (``text_id``) that are not content.

    Pages count by host and layout (their folded tree). Layouts, not pages, are aligned with the models of their host.
    Slots add up over all pages of a template, before the shuffle within each task, so a host with a third of all pages
    is as many rows as it has layouts. A slot whose text never changes is constant, and so is a text that every page
    with its slot has there; a template of one page has none.
    """
    source = pages.select(url_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    layouts = stage(source.mapInArrow(_layouts, LAYOUT), "layouts")
    known = layouts.groupBy("host", "layout").agg(F.min("skeleton").alias("skeleton"), F.sum("pages").alias("pages"))
    aligned = assign_templates(stage(known, "known"))
    slots = (
        layouts.join(aligned.select("host", "layout", "template", "nodes"), ["host", "layout"])
        .select(
            "host", "template", "pages", F.explode(F.arrays_zip("nodes", "low", "high", "chars", "links", "common")).alias("s")
        )
        .select("host", "template", "s.nodes.id", "s.nodes.above", "s.nodes.key", "pages", "s.low", "s.high", "s.chars", "s.links", "s.common")
    )
    slots = stage(slots, "slots")
    added = slots.groupBy("host", "template", "id").agg(
        F.min("above").alias("above"),
        F.min("key").alias("key"),
        F.sum("pages").alias("pages"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("chars").alias("chars"),
        F.sum("links").alias("links"),
    )
    texts = (
        slots.select("host", "template", "id", "pages", F.explode("common").alias("c"))
        .groupBy("host", "template", "id", "c.text")
        .agg(F.sum("pages").alias("having"), F.sum("c.chars").alias("chars"))
        .groupBy("host", "template", "id", "having")
        .agg(F.collect_list(F.struct("text", "chars")).alias("common"))
    )
    added = added.join(
        texts.withColumnRenamed("having", "pages"), ["host", "template", "id", "pages"], "left"
    ).withColumn("common", F.coalesce("common", F.expr("array()")))
    stats = added.groupBy("host", "template").agg(
        F.collect_list(F.struct("id", "above", "key", "pages", "low", "high", "chars", "links", "common")).alias("stats")
    )
    decided = stage(
        stats.mapInPandas(
            _decided,
            "host string, template string, kept array<long>, removed array<struct<id:long,texts:array<long>>>",
        ),
        "decided",
    )
    asked = aligned.select("host", "layout", "template", F.col("nodes.id").alias("ids")).join(decided, ["host", "template"])
    kinds = "host string, layout string, keep array<boolean>, constant array<array<long>>"
    return stage(asked.select("host", "layout", "ids", "kept", "removed").mapInPandas(_handed, kinds), "wrappers")


def extract_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every page by the wrapper of its host: key, ``url``, ``text``, ``n_chars`` (code points).

    White space inside a block becomes one space, blocks are joined by an empty line in page order. Null html gives an
    empty text; pages without a host are wrapped together; of a host with one page all is content that is not dropped
    by what it is. Repeated rows repeat; other columns are not read.
    """
    wrappers = induce(pages, url=url, html=html)
    kind = pages.schema[key].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.list_(pa.struct([("slot", pa.int32()), ("id", pa.int64()), ("text", pa.string())]))
        for batch in batches:
            layout, found = [], []
            for page in batch.column(3).to_pylist():
                tree = parse(page)
                layout.append(skeleton_id(tree.skeleton))
                found.append([{"slot": tree.slot[node], "id": text_id(text), "text": text} for node, text, _ in tree.blocks])
            columns = [*batch.columns[:3], pa.array(layout, pa.string()), pa.array(found, block)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "host", "layout", "blocks"])

    source = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), url_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    read = source.mapInArrow(blocks, f"id {kind}, url string, host string, layout string, blocks array<struct<slot:int,id:long,text:string>>")
    wrapped = read.join(wrappers, ["host", "layout"], "left")
    kept = F.filter(
        "blocks",
        lambda b: F.get(F.col("keep"), b["slot"]) & ~F.array_contains(F.get(F.col("constant"), b["slot"]), b["id"]),
    )
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n")
    return wrapped.select(F.col("id").alias(key), "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
