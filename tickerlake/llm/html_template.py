"""Main text of web pages by equivalence classes of template tokens.

Tokens are the markup containers of a page, each in its role: its path of
tags (with classes and ids, digits masked), what it begins with, and its number among
its like neighbours.  Pages of one host are compared:

1. For every host and token the occurrence vector over the host's pages is
   summed up as (pages, two sums of page hashes weighted by the count), so
   tokens with equal vectors have equal sums; and the text inside every token
   is summed up by its hash, as characters, characters in links and number of
   different texts.  Tasks add up their pages before the shuffle; a host that
   holds a third of all pages sends no more token rows than any other.
2. Tokens with equal vectors form a class.  A class is valid if it occurs on
   at least ``SUPPORT`` of the host's pages and its tokens lie in tokens of
   valid classes; valid classes nest into the template of the host.
3. The template parts a page into slots, one in each token.  A slot weighs as
   much as its text outside links, times the share of different texts among
   the host's pages: what repeats or links weighs little.  From the page down,
   the main slot is the token that holds ``DOMINANT`` of the weight around it,
   as long as one does.  Names only tip the scales: navigation, forms
   and the like and listed class names count less, ``main`` and ``article`` more.
4. Each page is read again with its host's template, and the main slot's text
   is its text, without elements inside it that HTML itself sets apart
   (``nav``, ``aside``, ``form`` ...) and without template tokens of a listed name
   that hold less than ``MINOR`` of the slot.  A page without the main slot of
   its host (another layout) is parted by its own tokens.

Templates reach the pages by a broadcast join while they are below
``BROADCAST_BYTES`` together, and by a shuffle join with salted hosts beyond.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one line break.  Block ends are block
tags and ``br``.

Defined results: a null or empty html has no text; a null url belongs to the
empty host; a host's only page is its own template; repeated rows each get
their text; of slots of equal weight the first in the page's order of names is
taken; a page without containers is one slot; very long pages are read whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import map_rows, ship, stored
from tickerlake.llm.urlfilter import host_and_path

SUPPORT = 0.5
DOMINANT = 0.5
MINOR = 0.3
BROADCAST_BYTES = 16_000_000
SALTS = 16
MOST_LINKED = 0.5

# Fixed vocabulary of the extraction.
CONTAINERS = frozenset("html body div section article main nav header footer aside form ul ol dl table figure dialog details menu".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd thead tbody tfoot tr td th caption blockquote pre hr br address figcaption summary fieldset legend option".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
NOISE_TAGS = frozenset("nav header footer aside form head button select svg dialog menu object audio video canvas".split()) | RAW
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored banner promo promotion sidebar side sidenav nav "
    "navbar navigation menu submenu breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist disqus replies "
    "respond widget toolbar pagination pager search copyright legal skip".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
PAGE_TAGS = frozenset("html body main article".split())
NAMED, NOISE = 1, 2

# What a token's name makes of its weight.
WEIGHT = {0: 1.0, NAMED: 0.5, NOISE: 0.1}
MAIN_WEIGHT, ARTICLE_WEIGHT = 4.0, 2.0

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe|noframes|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"[0-9]+")


def _describe(tag: str, attributes: str) -> tuple[str, int]:
    """(token name, NOISE, NAMED or 0) of an opening tag: boilerplate by its tag or state, by a class or id name only, or not.

    Class and id names do not make PAGE_TAGS boilerplate.
    """
    noise = NOISE * (tag in NOISE_TAGS)
    name = tag
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                name += "".join(f".{_DIGITS.sub('0', v)}" for v in sorted(value.split()))
                if tag not in PAGE_TAGS and any(p.lower() in NOISE_NAMES for p in _NAME_PART.findall(value)):
                    noise = max(noise, NAMED)
            elif key == "role":
                name += f"[{value}]"
                noise = max(noise, NOISE * (value.lower() in NOISE_ROLES))
            elif key == "hidden" or key == "style" and "display:none" in value.replace(" ", "").lower():
                noise = NOISE
    return name, noise


class Container:
    """An open element: its tag, name, own NOISE, NAMED or 0, the one around it, its role and the text inside it."""

    __slots__ = ("around", "begins", "chars", "linked", "mark", "name", "noise", "numbers", "role", "tag")

    def __init__(self, tag: str, name: str, noise: int, around: "Container | None"):
        self.tag, self.name, self.noise, self.around = tag, name, noise, around
        self.begins, self.role, self.numbers = "", "", {}
        self.chars = self.linked = self.mark = 0

    def begin(self, what: str) -> None:
        self.begins = self.begins or what


def events(page: str) -> tuple[list[tuple[Container | None, str, bool]], list[Container]]:
    """(container, decoded text, is link) or (None, "", False) at a block's end, in page order; and the containers as they open."""
    root = Container("", "", 0, None)
    stack, opened, found = [root], [], []
    described: dict[tuple[str, str], tuple[str, int]] = {}
    link = False
    at = 0

    def text(raw: str) -> None:
        found.append((stack[-1], entities.unescape(raw), link))
        if not raw.isspace():
            stack[-1].begin("#")

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        if m.group(3) is None:
            continue
        tag = m.group(3).lower()
        if tag == "a":
            link = not m.group(2)
        if tag in BLOCKS:
            found.append((None, "", False))
        if m.group(2):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        key = tag, m.group(4)
        if key not in described:
            described[key] = _describe(tag, m.group(4))
        name, noise = described[key]
        if tag == "body":
            del stack[1:]
        if tag in BLOCKS and stack[-1].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            stack.pop()  # an open paragraph ends where the next block starts
        stack[-1].begin(tag)
        if tag in VOID or m.group(4).endswith("/") or not (tag in CONTAINERS or noise):
            continue
        stack.append(Container(tag, name, noise, stack[-1]))
        opened.append(stack[-1])
    if at < len(page):
        text(page[at:])
    for c in opened:
        role = f"{c.name}/{c.begins}"
        n = c.around.numbers[role] = c.around.numbers.get(role, 0) + 1
        c.role = f"{c.around.role}>{role}:{n}" if n > 1 else f"{c.around.role}>{role}"
    return found, [root, *opened]


def weighed(page: str) -> list[Container]:
    """The containers with the characters, linked characters and hash of all text inside them."""
    found, opened = events(page)
    for c, text, link in found:
        if c is not None and (n := len(text.strip())):
            c.chars += n
            c.linked += n * link
            c.mark = zlib.crc32(text.encode("utf-8", "replace"), c.mark)
    for c in reversed(opened[1:]):  # inner ones open later
        c.around.chars += c.chars
        c.around.linked += c.linked
        c.around.mark = zlib.crc32(c.mark.to_bytes(4, "little"), c.around.mark)
    return opened


TOKEN = "host string, token string, variant long, pages long, noise long, sum1 long, sum2 long, chars long, linked long"


def host_tokens(pages: DataFrame) -> DataFrame:
    """TOKEN rows: per host and token its occurrence vector (variant 0; token '' counts the pages), and per text inside it how often
    (pages) it is there, its characters and linked characters (variant: its hash, from 1).  ``pages`` has host, key and html."""
    ship(pages.sparkSession)
    names = [f.split()[0] for f in TOKEN.split(", ")]
    schema = pa.schema([(n, pa.string() if n in ("host", "token") else pa.int64()) for n in names])

    def count(it):
        sums: dict[tuple[str, str, int], list[int]] = {}

        def add(key: tuple[str, str, int], noise: int, *values: int) -> None:
            s = sums.get(key)
            if s is None:
                s = sums[key] = [0] * 6
            s[1] = max(s[1], noise)
            for k, v in zip((0, 2, 3, 4, 5), values, strict=True):
                s[k] += v

        def flush():
            rows = [(*k, *v) for k, v in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in it:
            for host, key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen: dict[str, list[int]] = {}
                for c in weighed(page or ""):
                    own = seen.setdefault(c.role, [0, c.noise])
                    own[0] += 1
                    own[1] = max(own[1], c.noise)
                    if c.chars:
                        add((host, c.role, 1 + c.mark), 0, 1, 0, 0, c.chars, c.linked)
                for role, (n, noise) in seen.items():
                    mark = b"%d:%d" % (key, n)
                    add((host, role, 0), noise, 1, zlib.crc32(mark), zlib.adler32(mark[::-1]), 0, 0)
                if len(sums) > 100_000:
                    yield flush()
        if sums:
            yield flush()

    parts = pages.select("host", "key", "html").mapInArrow(count, TOKEN)
    return parts.groupBy("host", "token", "variant").agg(
        F.sum("pages").alias("pages"), F.max("noise").alias("noise"), *[F.sum(c).alias(c) for c in names[5:]])


def templates(tokens: DataFrame) -> DataFrame:
    """One row per host: host, tokens (token, class, main, drop) - the nested valid classes with the main slot.

    ``tokens`` are host_tokens; at most 1 / SUPPORT times a page's tokens are left per host.
    """
    vectors = tokens.where("variant = 0").drop("variant", "chars", "linked")
    texts = tokens.where("variant != 0").groupBy("host", "token").agg(
        F.count("*").alias("variants"), F.sum("pages").alias("texts"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    size = vectors.where("token = ''").select("host", F.col("pages").alias("host_pages"))
    often = vectors.join(size, "host").where(F.col("pages") >= SUPPORT * F.col("host_pages"))
    grouped = often.join(texts, ["host", "token"], "left").groupBy("host").agg(F.collect_list(F.struct(
        "token", "pages", "noise", "sum1", "sum2", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("variants", "texts", "chars", "linked")])).alias("found"))

    def make():
        def run(rows):
            for host, found in rows:
                yield host, deduced([tuple(f.values()) for f in found])
        return run

    return map_rows(grouped, make, "host string, tokens array<struct<token: string, class: int, main: boolean, drop: boolean>>")


def own_tokens(page: str) -> list[tuple]:
    """The tokens of a page as those of a host that has no other."""
    seen: dict[str, list[int]] = {}
    for c in weighed(page):
        t = seen.setdefault(c.role, [0, 0, 0, 0, 0])
        t[0] += 1
        t[1] = max(t[1], c.noise)
        t[2] += bool(c.chars)
        t[3] += c.chars
        t[4] += c.linked
    return [(role, 1, noise, n, n, texts, texts, chars, linked) for role, (n, noise, texts, chars, linked) in seen.items()]


def deduced(found: list[tuple]) -> list[dict]:
    """Template of one host from its frequent tokens: (token, pages, noise, sum1, sum2, variants, texts, chars, linked)."""
    by_vector: dict[tuple, list[str]] = defaultdict(list)
    for token, pages, _, sum1, sum2, *_ in found:
        if token:
            by_vector[pages, sum1, sum2].append(token)
    classes = sorted(by_vector.values(), key=lambda c: (min(t.count(">") for t in c), sorted(c)))
    valid: dict[str, int] = {"": 0}
    for number, tokens in enumerate(classes, 1):
        own = set(tokens)
        if all((outer := t.rpartition(">")[0]) in valid or outer in own for t in tokens):
            valid.update(dict.fromkeys(tokens, number))
    noise = {f[0]: f[2] for f in found}
    mass = {t: (chars - linked) * variants / texts if linked <= MOST_LINKED * chars and texts else 0.0
            for t, _, _, _, _, variants, texts, chars, linked in found}
    plain = {f[0]: f[7] - f[8] for f in found}
    inner: dict[str, list[str]] = defaultdict(list)
    for t in sorted(valid):
        if t:
            inner[t.rpartition(">")[0]].append(t)
    main = ""
    while inner[main]:
        weight = {t: mass[t] * WEIGHT[noise[t]] * _named_weight(t, valid) for t in inner[main]}
        best = max(inner[main], key=lambda t: weight[t])
        rest = max(0, plain.get(main, 0) - sum(plain[t] for t in inner[main]))  # text outside the inner ones
        if not weight[best] or weight[best] < DOMINANT * (sum(weight.values()) + rest):
            break
        if _tag(main) in ("main", "article") and _named_weight(best, valid) == 1.0:
            break  # an article is not narrowed to a part of it
        main = best
    return [{"token": t, "class": valid[t], "main": t == main,
             "drop": t.startswith(f"{main}>") and noise[t] == NAMED and mass[t] < MINOR * mass[main]} for t in sorted(valid) if t]


def _tag(token: str) -> str:
    """The tag of a token's last element."""
    return token.rpartition(">")[2].split("/")[0].split(".")[0].split("[")[0]


def _named_weight(token: str, valid: dict[str, int]) -> float:
    """More for a token that is, or holds, a ``main`` or ``article`` element."""
    tags = {_tag(t) for t in valid if t == token or t.startswith(f"{token}>")}
    return MAIN_WEIGHT if "main" in tags else ARTICLE_WEIGHT if "article" in tags else 1.0


def main_text(page: str, template: list[tuple[str, bool, bool]] | None) -> str:
    """Main text of a page with its host's template: (token, main, drop), or None to take the page's own tokens."""
    if not page:
        return ""
    found, opened = events(page)
    if template is None or any(main for _, main, _ in template) and not any(
            main and c.role == token for c in opened for token, main, _ in template if main):
        template = [(t["token"], t["main"], t["drop"]) for t in deduced(own_tokens(page))]
    main = {token for token, is_main, _ in template if is_main}
    drop = {token for token, _, is_dropped in template if is_dropped}
    taken: dict[int, bool] = {}  # whether text directly in a container is main text
    inside: dict[int, bool] = {}
    for c in opened:
        within = c.around is not None and inside[id(c.around)]
        inside[id(c)] = within or c.role in main or not main
        apart = within and (c.noise == NOISE or c.role in drop)
        taken[id(c)] = inside[id(c)] and not apart and (not within or taken[id(c.around)])
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(text)
        parts.clear()

    before = None
    for c, text, _ in found:
        if c is None:
            close()
        elif taken[id(c)]:
            if before is not None and taken[id(before)] != taken[id(c)]:
                close()
            parts.append(text)
        if c is not None:
            if before is not None and not taken[id(c)] and taken[id(before)]:
                close()
            before = c
    close()
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", "html", host.alias("host"), F.xxhash64("page_id", "url").alias("key"))
    tokens = stored(host_tokens(rows), "html-tokens")
    found = stored(templates(tokens).select("host", F.expr("transform(filter(tokens, t -> t.main or t.drop), t -> struct(t.token, t.main, t.drop))").alias("template")), "html-templates")
    weight = found.agg(F.sum(F.expr("aggregate(template, 0L, (a, t) -> a + length(t.token) + 16)"))).first()[0] or 0
    rows = rows.select("page_id", "url", "html", "host", "key")
    if weight <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(found), "host", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def make():
        def run(batch):
            for page_id, url, page, template in batch:
                text = main_text(page or "", None if template is None else [tuple(t.values()) for t in template])
                yield page_id, url, text, len(text)
        return run

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_rows(joined.select("page_id", "url", "html", "template"), make, f"page_id {kind}, url string, text string, n_chars long")
