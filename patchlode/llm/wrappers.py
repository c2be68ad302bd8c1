"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

1. A page is a stream of tags and texts. Neighbouring equal groups of tokens fold into one repeated group,
   which leaves a pattern of tags, text slots and repeated groups. Pages with equal patterns are one pattern.
2. The patterns of a host are aligned one after the other with the wrapper so far (longest common
   subsequence of nodes): what both have stays, a group met once and repeated becomes repeated, and what only one
   side has becomes optional. Partial wrappers of a host are made in several tasks and then aligned with each other, so
   a large host is never in one task.
3. Every pattern is aligned with its host's wrapper, and what all pages hold is counted at the wrapper's slots: pages, texts, words,
   words in links, whether the text is ever another one, and whether at least ``LEAST_PAGES`` different pages have it. Pages
   are different if their texts outside furniture and links are, so copies, and new ads around an old article, count once.
   ``decide`` reads fixed texts, link lists, labelled boxes and comments off the wrapper and these counts.
4. Each page is aligned with the wrapper, and its texts take the role of the slot they fell on. Texts on no slot are read
   by their place (the containers around them), counted in the same way. Furniture by element or name is never main text; if some
   texts of a page lie in an article or main element, only those count.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stage
from .words import chunks

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|[^<]+|<",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
# fixed values: elements of HTML
_RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "select", "svg", "object", "math", "canvas", "video", "audio")
_CONTAINERS = frozenset(
    "html head body div section article main nav header footer aside form ul ol dl table figure blockquote details dialog fieldset menu center pre".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("head nav header footer aside form menu dialog button".split())
# fixed values: words in class, id or role that name page furniture
_NAMED = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "header masthead footer sidebar aside widget widgets comment comments commentlist disqus replies respond cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended pagination pager "
    "complementary contentinfo toolbar copyright skip tracking paywall".split())
_MAIN = frozenset("article main".split())
_LABELS = frozenset("h1 h2 h3 h4 h5 h6 dt th td caption figcaption".split())
_SLOT = "path string, pages bigint, texts bigint, words bigint, linked bigint, low bigint, high bigint, different array<bigint>"
_SLOT_TYPE = pa.struct([("path", pa.string()), *((c, pa.int64()) for c in ("pages", "texts", "words", "linked", "low", "high")), ("different", pa.list_(pa.int64()))])
GROUP = 12
LEAST_PAGES = 3
SHORT_NAME, SHORT_LINE = 6, 12


def tokens(page: str) -> Iterator[tuple[str, str, tuple, bool]]:
    """(tag or "#", text, containers, inside a link) of a page in order; scripts, styles and comments are left out."""
    at, stack, block, links = 0, [], "", 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        slash, name, rest, other_slash, other_name, other_rest = m.groups()
        name = name or other_name
        if name is None:
            text = m.group()
            if not text.startswith(("<!", "<?")):
                if text.isspace():
                    yield "", text, (), False
                else:
                    yield "#", text, (*stack, block), links > 0
            continue
        name, closing, rest = name.lower(), bool(slash or other_slash), rest or other_rest or ""
        if name in _RAW:
            if not closing and not rest.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "a":
            links = 0 if closing else 1
        sign = name
        if name in _CONTAINERS:
            links = 0
            if closing:
                places = [i for i, s in enumerate(stack) if s.split(" ", 1)[0] == name]
                if places:
                    del stack[places[-1] :]
            else:
                if name == "body":
                    stack.clear()
                named = sorted({w for _, x, y, z in _NAMES.findall(rest) for w in re.split(r"[^a-z]+", (x or y or z).lower()) if w})
                if _HIDDEN.search(rest):
                    named.append("hidden")
                sign = " ".join([name, *named])
                stack.append(sign)
            block = ""
        elif name not in _INLINE and name not in _VOID:
            block = "" if closing else name
        yield ("/" if closing else "") + sign, "", (), False


def fold(stream: list[str]) -> tuple[tuple, list[list[int]]]:
    """Pattern of a stream, and for each of its text slots the numbers of the texts in it.

    A node is a tag, ``#``, or a tuple of nodes: a group met several times in a row.
    """
    keys: list = []
    held: list[list[list[int]]] = []
    text = 0

    def joined(g: int) -> list[list[int]]:
        return [s for own in held[-g:] for s in own]

    for token in stream:
        keys.append(token)
        held.append([[text]] if token == "#" else [])
        text += token == "#"
        folded = True
        while folded:
            folded = False
            last = keys[-1]
            for g in range(1, min(GROUP, len(keys) - 1) + 1):
                before = keys[-g - 1]
                if type(before) is tuple and len(before) == g and before[-1] == last and before == tuple(keys[-g:]):
                    for old, new in zip(held[-g - 1], joined(g), strict=True):
                        old += new
                    del keys[-g:], held[-g:]
                    folded = True
                    break
                if before == last and (g > 1 or last != "#") and 2 * g <= len(keys) and keys[-g:] == keys[-2 * g : -g]:
                    new = joined(g)
                    group = tuple(keys[-g:])
                    del keys[-g:], held[-g:]
                    slots = [a + b for a, b in zip(joined(g), new, strict=True)]
                    del keys[-g:], held[-g:]
                    keys.append(group)
                    held.append(slots)
                    folded = True
                    break
    return tuple(keys), [s for own in held for s in own]


def align(wrapper: list, pattern: list) -> list:
    """The wrapper that takes both: nodes [content, repeated, optional]; content is a tag or a list of nodes."""
    wrapper, pattern = grouped(wrapper, pattern), grouped(pattern, wrapper)
    keys = [[json.dumps(_bare(n)) for n in side] for side in (wrapper, pattern)]
    merged: list = []
    for op, a, b, c, d in SequenceMatcher(None, *keys, autojunk=False).get_opcodes():
        if op == "equal":
            merged += [[x[0], x[1] or y[1], x[2] or y[2]] for x, y in zip(wrapper[a:b], pattern[c:d], strict=True)]
        else:
            merged += [[n[0], n[1], True] for n in [*wrapper[a:b], *pattern[c:d]]]
    return merged


def grouped(nodes: list, other: list) -> list:
    """The nodes, with what the other side repeats and this side has once made a group as well, longest groups first."""
    bodies = {tuple(json.dumps(_bare(n)) for n in content) for content, _, _ in other if not isinstance(content, str)}
    keys = [json.dumps(_bare(n)) for n in nodes]
    for body in sorted(bodies, key=lambda b: (-len(b), b)):
        if body[0] not in keys:
            continue
        new_nodes, new_keys, at = [], [], 0
        while at < len(keys):
            inner = nodes[at : at + len(body)] if keys[at] == body[0] and tuple(keys[at : at + len(body)]) == body else None
            new_nodes.append([inner, True, any(n[2] for n in inner)] if inner else nodes[at])
            new_keys.append(json.dumps([json.loads(k) for k in body]) if inner else keys[at])
            at += len(inner or [0])
        nodes, keys = new_nodes, new_keys
    return nodes


def _bare(node: list) -> object:
    content = node[0]
    return content if isinstance(content, str) else [_bare(n) for n in content]


def _nodes(pattern) -> list:
    """A folded pattern as wrapper nodes."""
    return [[n, False, False] if isinstance(n, str) else [_nodes(n), True, False] for n in pattern]


def _slots(nodes: list) -> int:
    return sum((n[0] == "#") if isinstance(n[0], str) else _slots(n[0]) for n in nodes)


def slot_numbers(wrapper: list, pattern: list) -> list[int | None]:
    """For each slot of an aligned pattern the number of the wrapper's slot it fell on."""
    pattern = grouped(pattern, wrapper)
    keys = [[json.dumps(_bare(n)) for n in side] for side in (wrapper, pattern)]
    first, total = [], 0
    for n in wrapper:
        first.append(total)
        total += _slots([n])
    at: dict[int, int] = {}
    for a, b, size in SequenceMatcher(None, *keys, autojunk=False).get_matching_blocks():
        at.update({b + i: first[a + i] for i in range(size)})
    found: list[int | None] = []
    for i, n in enumerate(pattern):
        found += [None if i not in at else at[i] + j for j in range(_slots([n]))]
    return found


@lru_cache(1 << 14)
def furniture(path: tuple) -> bool:
    """Whether elements or names around a text make it page furniture."""
    heading = path[-1] in ("h1", "h2") and any(p.split(" ", 1)[0] in _MAIN for p in path[:-1])
    for sign in path[:-1]:
        name, *named = sign.split(" ")
        if name in ("html", "body"):
            continue
        if name in _FURNITURE and not (name == "header" and heading):
            return True
        if "hidden" in named or (name not in _MAIN and _NAMED.intersection(named)):
            return True
    return path[-1] in _FURNITURE or path[-1] in ("title", "option", "legend")


@lru_cache(1 << 14)
def _place(path: tuple) -> str:
    return json.dumps(path)


@lru_cache(1 << 14)
def in_main(path: tuple) -> bool:
    return any(p.split(" ", 1)[0] in _MAIN or p.split(" ")[1:].count("main") for p in path[:-1] if p.split(" ", 1)[0] != "body")


def regions(wrapper: list) -> list[tuple[tuple[int, ...], bool]]:
    """For each slot of a wrapper: the containers around it (numbers of their opening nodes), and whether it lies in a repeated group."""
    found: list[tuple[tuple[int, ...], bool]] = []
    stack: list[tuple[str, int]] = []
    seen = 0

    def walk(nodes: list, repeated: bool) -> None:
        nonlocal seen
        for content, again, _ in nodes:
            if not isinstance(content, str):
                walk(content, repeated or again)
                continue
            seen += 1
            name = content.lstrip("/").split(" ", 1)[0]
            if content == "#":
                found.append((tuple(n for _, n in stack), repeated))
            elif name in _CONTAINERS and content[0] != "/":
                stack.append((name, seen))
            elif name in _CONTAINERS:
                places = [i for i, (s, _) in enumerate(stack) if s == name]
                if places:
                    del stack[places[-1] :]

    walk(wrapper, False)
    return found


def decide(wrapper: list, slots: dict[int, dict]) -> list[int]:
    """Numbers of the wrapper's slots that are no main text, from what all pages of the host hold at them.

    - fixed: equal on several different pages and met on more than half of those of the most frequent slot;
    - containers whose own text is mostly in links;
    - labelled boxes: a container beside the main one that opens with a fixed text in a block of its own, before short lines or comments;
    - comments: a container after the main one's text, with a repeated group in which a short name or date stands
      beside a longer text in another block, and not as a heading.

    The main container is the one that directly holds most words outside links, furniture and fixed texts.
    """
    around = regions(wrapper)
    facts = {n: {**x, "path": tuple(json.loads(x["path"]))} for n, x in slots.items()}
    often = max((x["pages"] for x in facts.values()), default=0)
    plain = {n for n, x in facts.items() if not furniture(x["path"])}
    fixed = {n for n, x in facts.items() if x["different"] >= LEAST_PAGES and x["low"] == x["high"] and 2 * x["pages"] > often}
    direct: dict[int, list[int]] = {}
    under: dict[int, list[int]] = {}
    for n in sorted(facts):
        for c in around[n][0]:
            under.setdefault(c, []).append(n)
        for c in around[n][0][-1:]:
            direct.setdefault(c, []).append(n)

    def weight(c: int) -> tuple[bool, int]:
        own = [facts[n] for n in direct[c] if n in plain and n not in fixed]
        return any(in_main(x["path"]) for x in own), sum(x["words"] - x["linked"] for x in own)

    core = max(direct, key=weight, default=None)
    if core is None:
        return sorted(fixed)
    core_path = around[direct[core][0]][0]
    end = max((n for n in direct[core] if n in plain and n not in fixed), default=-1)
    dropped = set(fixed)

    def per_text(numbers: list[int]) -> float:
        return sum(facts[n]["words"] for n in numbers) / max(1, sum(facts[n]["texts"] for n in numbers))

    def comments(numbers: list[int]) -> bool:
        blocks: dict[tuple, list[int]] = {}
        for n in numbers:
            if around[n][1]:
                blocks.setdefault(facts[n]["path"], []).append(n)
        names = [p for p, own in blocks.items() if p[-1] not in _LABELS and per_text(own) <= SHORT_NAME]
        return any(p != q and per_text(own) > per_text(blocks[q]) for q in names for p, own in blocks.items())

    for c, numbers in under.items():
        own = direct.get(c, [])
        if own and 2 * sum(facts[n]["linked"] for n in own) > sum(facts[n]["words"] for n in own):
            dropped.update(own)
        if c in core_path or max(facts[n]["different"] for n in numbers) < LEAST_PAGES:
            continue
        label, rest = numbers[0], [n for n in numbers if n not in fixed]
        box = label in fixed and rest and all(facts[n]["path"] != facts[label]["path"] for n in rest)
        if box and (per_text(rest) <= SHORT_LINE or comments(rest)) or numbers[0] > end and comments(numbers):
            dropped.update(numbers)
    return sorted(dropped)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host: patterns with their pages, and places of texts with their counts, over one batch each."""
    for batch in batches:
        for part in chunks(batch, "html", 8 << 20):
            patterns: dict[tuple[str, str], int] = {}
            places: dict[tuple[str, str], list[int]] = {}
            different: dict[tuple[str, str], set[int]] = {}
            slots: dict[tuple[str, str], list[dict]] = {}
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                found = [t for t in tokens(page or "") if t[0]]
                pattern, held = fold([t[0] for t in found])
                key = (host, json.dumps(pattern))
                patterns[key] = patterns.get(key, 0) + 1
                own: dict[str, list[int]] = {}
                hashes: dict[str, xxhash.xxh3_64] = {}
                plain: dict[str, bool] = {}
                texts = []
                for kind, text, path, link in found:
                    if kind == "#":
                        words = text.split()
                        p, n, said = _place(path), len(words), " ".join(words).encode("utf-8", "replace")
                        texts.append((p, n, n * link, said))
                        x = own.setdefault(p, [0, 0])
                        x[0] += n
                        x[1] += n * link
                        plain[p] = not furniture(path)
                        hashes.setdefault(p, xxhash.xxh3_64()).update(said)
                content = sorted((p, hashes[p].intdigest()) for p, (n, linked) in own.items() if plain[p] and 2 * linked <= n)
                page_hash = xxhash.xxh3_64_intdigest(json.dumps(content).encode()) >> 1
                _add_slots(slots.setdefault(key, [{} for _ in held]), held, texts, page_hash)
                for p, (n, linked) in own.items():
                    _add_page(different.setdefault((host, p), set()), page_hash)
                    h = hashes[p].intdigest() >> 1
                    x = places.setdefault((host, p), [0, 0, 0, h, h])
                    x[0], x[1], x[2], x[3], x[4] = x[0] + 1, x[1] + n, x[2] + linked, min(x[3], h), max(x[4], h)
            rows = [(h, k, n, 0, 0, 0, 0, None, False, [{**x, "different": sorted(x["different"])} for x in slots[h, k]]) for (h, k), n in patterns.items()]
            rows += [(h, k, *x, sorted(different[h, k]), True, None) for (h, k), x in places.items()]
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.bool_(), pa.list_(_SLOT_TYPE)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             ["host", "what", "pages", "words", "linked", "low", "high", "different", "place", "slots"])


def _add_page(known: set[int], page_hash: int) -> None:
    """Keep the smallest hashes of different pages, as many as it takes to tell."""
    known.add(page_hash)
    if len(known) > LEAST_PAGES:
        known.remove(max(known))


def _add_slots(facts: list[dict], held: list[list[int]], texts: list[tuple], page_hash: int) -> None:
    """Add one page to the facts of its pattern's slots. Texts: place, words, words in links, text."""
    for x, numbers in zip(facts, held, strict=True):
        h = xxhash.xxh3_64_intdigest(b" ".join(texts[i][3] for i in numbers)) >> 1
        if not x:
            x.update(path=texts[numbers[0]][0], pages=0, texts=0, words=0, linked=0, low=h, high=h, different=set())
        x["pages"] += 1
        x["texts"] += len(numbers)
        x["words"] += sum(texts[i][1] for i in numbers)
        x["linked"] += sum(texts[i][2] for i in numbers)
        x["low"], x["high"] = min(x["low"], h), max(x["high"], h)
        _add_page(x["different"], page_hash)


def _merge(table: pa.Table) -> pa.Table:
    """One wrapper of a group of patterns or wrappers, the most frequent first."""
    rows = sorted(zip(table["pages"].to_pylist(), table["what"].to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
    wrapper: list = []
    for i, (_, what) in enumerate(rows):
        nodes = json.loads(what)
        wrapper = align(wrapper, nodes) if i else nodes
    return pa.table({"host": table["host"].slice(0, 1), "what": pa.array([json.dumps(wrapper)]), "pages": pa.array([sum(r[0] for r in rows)], pa.int64())})


def _as_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        what = pa.array([json.dumps(_nodes(json.loads(w))) for w in batch.column("what").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("host"), what, batch.column("pages"), batch.column("salt")], ["host", "what", "pages", "salt"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of patterns' slots under the numbers of the wrapper's slots they fell on."""
    parsed: dict[str, list] = {}
    for batch in batches:
        hosts, numbers, facts = [], [], []
        for host, what, slots, wrapper in zip(*(batch.column(c).to_pylist() for c in ("host", "what", "slots", "wrapper")), strict=True):
            if host not in parsed:
                parsed.clear()
                parsed[host] = json.loads(wrapper)
            for number, x in zip(slot_numbers(parsed[host], _nodes(tuple(_tuples(json.loads(what))))), slots, strict=True):
                if number is not None:
                    hosts.append(host)
                    numbers.append(number)
                    facts.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(numbers, pa.int64()), *pa.array(facts, _SLOT_TYPE).flatten()],
                                         ["host", "number", *(f.name for f in _SLOT_TYPE)])


def _tuples(pattern: list) -> list:
    return [n if isinstance(n, str) else tuple(_tuples(n)) for n in pattern]


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "wrapper"):
            wrappers = [json.loads(w) for w in part.column("wrapper").to_pylist()]
            slots = [{x["number"]: x for x in xs or ()} for xs in part.column("slots").to_pylist()]
            off = pa.array([decide(w, x) for w, x in zip(wrappers, slots, strict=True)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("host"), part.column("wrapper"), off], ["host", "wrapper", "off"])


def infer_wrappers(pages: DataFrame, parts: int = 32) -> tuple[DataFrame, DataFrame]:
    """Wrappers (host, wrapper, off: numbers of slots that are no main text) and places (host, places, fixed) that
    are none, from all pages (host, html)."""
    facts = stage(pages.select("host", "html").mapInArrow(
        _facts, "host string, what string, pages bigint, words bigint, linked bigint, low bigint, high bigint, different array<bigint>, place boolean, "
        f"slots array<struct<{_SLOT.replace(' ', ':').replace(',:', ', ')}>>"), "facts")
    patterns = facts.where("not place").groupBy("host", "what").agg(F.sum("pages").alias("pages"))
    salted = patterns.withColumn("salt", F.pmod(F.xxhash64("what"), F.lit(parts)))
    schema = "host string, what string, pages bigint"
    some = salted.mapInArrow(_as_wrappers, schema + ", salt bigint").groupBy("host", "salt").applyInArrow(_merge, schema)
    wrappers = stage(some.groupBy("host").applyInArrow(_merge, schema).select("host", F.col("what").alias("wrapper")), "merged")
    pages_seen = F.size(F.array_distinct(F.flatten(F.collect_list("different")))).alias("different")
    counted = facts.where("not place").select("host", "what", "slots").join(wrappers, "host").mapInArrow(_numbered, f"host string, number bigint, {_SLOT}")
    slots = counted.groupBy("host", "number").agg(
        F.min("path").alias("path"), *(F.sum(c).alias(c) for c in ("pages", "texts", "words", "linked")),
        F.min("low").alias("low"), F.max("high").alias("high"), pages_seen)
    slots = slots.groupBy("host").agg(F.collect_list(F.struct(*(c for c in slots.columns if c != "host"))).alias("slots"))
    decided = wrappers.join(slots, "host", "left").mapInArrow(_decided, "host string, wrapper string, off array<bigint>")
    places = facts.where("place").groupBy("host", "what").agg(
        *(F.sum(c).alias(c) for c in ("words", "linked")), F.min("low").alias("low"), F.max("high").alias("high"), pages_seen)
    fixed = (F.col("different") >= LEAST_PAGES) & (F.col("low") == F.col("high"))
    bad = places.where(fixed | (2 * F.col("linked") > F.col("words"))).groupBy("host").agg(
        F.collect_set("what").alias("places"), F.collect_set(F.when(fixed, F.col("what"))).alias("fixed"))
    return decided, bad


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, list] = {}
    for batch in batches:
        for part in chunks(batch, "html"):
            texts = []
            columns = (part.column(c).to_pylist() for c in ("host", "html", "wrapper", "places", "fixed", "off"))
            for host, page, wrapper, bad, fixed, off in zip(*columns, strict=True):
                texts.append(main_text(page or "", wrapper, set(bad or ()), known, host, set(fixed or ()), set(off or ())))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_text(
    page: str, wrapper: str | None, bad: set[str], known: dict, host: str | None, fixed: set[str] = frozenset(), off: set[int] = frozenset(),
) -> str:
    """The joined texts of the page's main slots: not in ``off``, nor at a ``fixed`` place; texts that fell on no slot are
    read by their place (``bad``). ``known`` keeps alignments of patterns met before."""
    stream = list(tokens(page))
    kept = [t for t in stream if t[0]]
    pattern, slots = fold([t[0] for t in kept])
    key = (host, pattern)
    if key not in known:
        if len(known) > 5000:
            known.clear()
        known[key] = slot_numbers(json.loads(wrapper), _nodes(pattern)) if wrapper else [None] * len(slots)
    paths = [t[2] for t in kept if t[0] == "#"]
    role: dict[int, bool] = {}
    for number, held in zip(known[key], slots, strict=True):
        for i in held:
            place = _place(paths[i])
            role[i] = not furniture(paths[i]) and (place not in bad if number is None else number not in off and place not in fixed)
    if any(role[i] and in_main(paths[i]) for i in role):
        role = {i: good and in_main(paths[i]) for i, good in role.items()}
    blocks, current, text = [], [], -1
    for tag, raw, _, _ in stream:
        if tag == "":
            current.append(" ")
        elif tag == "#":
            text += 1
            if role[text]:
                current.append(html_lib.unescape(raw))
        elif tag.lstrip("/").split(" ", 1)[0] not in _INLINE:
            blocks.append("".join(current))
            current = []
    blocks.append("".join(current))
    return " ".join(b for b in (" ".join(x.split()) for x in blocks) if b).encode("utf-8", "replace").decode()


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (empty if none), n_chars.

    The host is the part of the url between ``//`` and the next ``/``, lower-cased; pages with a null or hostless
    url form one host. Null html is empty. Repeated rows are answered alike. Other columns are not read.
    An empty table gives an empty result.
    """
    host = F.lower(F.coalesce(F.regexp_extract(url_col, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    wrappers, bad = infer_wrappers(rows)
    wrappers = stage(wrappers.join(bad, "host", "left"), "wrappers")
    found = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "host", "wrapper", "places", "fixed", "off")
    return found.mapInArrow(_extract, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))
