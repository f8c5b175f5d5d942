"""Main text of web pages by deducing each host's template from equivalence classes of tokens.

1. A page is read as tokens: its start, tags named by their path, and text blocks under their path.
2. Tokens of one host that occur equally often on each of its pages share an occurrence vector and form a class.
   Vectors are compared by a combination of hashes of page and occurrences, so classes come from an
   aggregation that combines on the map side, however many pages a host has.  Large classes that stand on
   most pages are tested; the one with the start of the page is the template's root.
3. A class is ordered if its tokens follow each other alike on all pages, and nested if it never crosses
   another ordered class; of two that cross the smaller is given up.
4. Tokens outside valid classes take roles by the gap of the innermost class they stand in, and steps 2 and 3 are
   repeated over the roles, so that a tag or text used in several places falls into the classes of each.
5. Text in valid classes is the template's, on every page.  What is left stands in slots, of which those
   under navigation, notices, forms and the like, and beside the main element if the page has one, are no main text.
"""

from __future__ import annotations

import html
import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import materialize

# Elements of HTML by their use.
SKIPPED = {"script", "style", "noscript", "template", "svg", "head", "title", "iframe", "object", "canvas", "math"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "button", "select", "textarea", "dialog"}
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
MAIN = {"article", "main"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert"}
MARKS = set(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notices menu "
    "navbar navigation sidebar breadcrumb breadcrumbs comment comments discussion reply replies respond share social "
    "related newsletter subscribe popup modal footer header toolbar widget".split()
)

#: A host with fewer pages has no template.
LEAST_PAGES = 4
#: Tokens of the least class that is part of a template, and times that roles are told apart.
LEAST_TOKENS = 3
ROUNDS = 2
#: Token of the start of a page.
START = 0
#: Parts a host's template is copied to, so that no task holds a whole host.
SALTS = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|noscript|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: Elements that a like element or the end of their parent closes.
_CLOSED_BY_LIKE = {"p", "li", "td", "th", "tr", "dt", "dd", "option"}


def host_of(url: Column) -> Column:
    """Host in lower case without port; NULL or shapeless urls share the empty host."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit(""))


def unwanted(name: str, attrs: str, in_main: bool) -> bool:
    if name in SKIPPED or (name in BOILERPLATE and not (in_main and name == "header")):
        return True
    if not attrs:
        return False
    for key, *values in _ATTR.findall(attrs):
        value = "".join(values).lower()
        if (key.lower() == "role" and value in ROLES) or (key.lower() != "role" and MARKS & set(_WORDS.findall(value))):
            return True
    return bool(_HIDDEN.search(attrs))


def blocks_of(page: str | None) -> list[tuple[str, str, bool, bool, bool]]:
    """(path, text, wanted, in main, text or tag) in page order; a tag's text is empty.

    Text is decoded, its white space folded; inline elements do not end a block.
    """
    page = page or ""
    found: list[tuple[str, str, bool, bool, bool]] = []
    stack: list[tuple[str, str, bool, bool]] = []  # name, path, wanted, in main
    held: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            _, path, wanted, main = at_flush()
            found.append((path, text, wanted, main, True))

    def at_flush() -> tuple[str, str, bool, bool]:
        for entry in reversed(stack):
            if entry[0] not in INLINE:
                return entry
        return "", "", True, False

    def open_entry() -> tuple[str, str, bool, bool]:
        return stack[-1] if stack else ("", "", True, False)

    last = 0
    for match in _TOKEN.finditer(page):
        if match.start() > last and open_entry()[2]:
            held.append(page[last : match.start()])
        elif match.start() > last:
            # Text under an unwanted element stands apart from what surrounds it.
            flush_unwanted = _SPACE.sub(" ", html.unescape(page[last : match.start()])).strip()
            if flush_unwanted:
                found.append((open_entry()[1], flush_unwanted, False, open_entry()[3], True))
        last = match.end()
        if match["name"] is None:
            continue
        name = match["name"].lower()
        if match["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if name not in INLINE:
                flush()
            if depth >= 0 and (name not in INLINE or all(e[0] in INLINE for e in stack[depth:])):
                del stack[depth:]
            continue
        attrs = match["attrs"]
        _, _, wanted, main = open_entry()
        refused = wanted and unwanted(name, attrs, main)
        if name not in INLINE or refused:
            flush()
            # A block ends inline elements left open, and a like element it cannot stand in.
            if name in _CLOSED_BY_LIKE:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), -1)
                if depth >= 0 and stack[depth][0] == name:
                    del stack[depth:]
        if name in VOID or attrs.endswith("/"):
            continue
        _, path, wanted, main = open_entry()
        marks = ".".join("".join(v) for k, *v in _ATTR.findall(attrs)) if attrs else ""
        path = f"{path}/{name}{'#' + marks if marks else ''}" if name not in INLINE else path
        stack.append((name, path, wanted and not refused, main or name in MAIN))
        if name not in INLINE:
            found.append((path, "", wanted and not refused, main or name in MAIN, False))
    if last < len(page) and open_entry()[2]:
        held.append(page[last:])
    flush()
    return found


def token_hash(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text}".encode("utf-8", "replace")) - (1 << 63)


def tokens_of(blocks: list[tuple[str, str, bool, bool, bool]]) -> list[int]:
    return [START, *(token_hash(path, text) for path, text, *_ in blocks)]


def refined(roles: list[int], valid: dict[int, tuple[int, int, int]]) -> list[int]:
    """Roles told apart by the token of the innermost open class they follow; ``valid``: class, rank and size of a role."""
    out = []
    stack: list[tuple[int, int]] = []  # open classes, each with the token that opened the present gap
    for role in roles:
        if role not in valid:
            gap = stack[-1][1] if stack else START
            out.append(xxhash.xxh64_intdigest(struct.pack("<qq", role, gap)) - (1 << 63))
            continue
        group, rank, size = valid[role]
        if rank:
            stack.pop()
        if rank < size - 1:
            stack.append((group, role))
        out.append(role)
    return out


def tested(roles: list[int], found: dict[int, tuple[int, int, int]]) -> tuple[dict[int, tuple[int, int]], set[tuple[int, int]]]:
    """Least and greatest rank of each role in its class on a page, and (smaller, larger) classes that cross there.

    ``found``: class, size and pages of a role.  A class that ends open or repeats a token before it is full has rank -1.
    """
    ranks: dict[int, tuple[int, int]] = {}
    crossed: set[tuple[int, int]] = set()
    stack: list[tuple[int, set[int]]] = []
    for role in roles:
        if role not in found:
            continue
        group, size, pages = found[role]
        depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == group), len(stack))
        if depth == len(stack):
            stack.append((group, set()))
        for other, members in stack[depth + 1 :]:
            _, other_size, other_pages = found[next(iter(members))]
            smaller = min((pages, size, group), (other_pages, other_size, other))[2]
            crossed.add((smaller, other if smaller == group else group))
        seen = stack[depth][1]
        rank = -1 if role in seen else len(seen)
        seen.add(role)
        low, high = ranks.get(role, (rank, rank))
        ranks[role] = min(low, rank), max(high, rank)
        if len(seen) == size:
            del stack[depth]
    for _, members in stack:
        ranks.update((role, (-1, max(0, ranks[role][1]))) for role in members)
    return ranks, crossed


def main_text(page: str | None, rounds: list[dict[int, tuple[int, int, int]]]) -> str:
    """Text of the slots outside unwanted elements; only those in the main element, if the page has one.

    ``rounds``: the valid classes of each round over the page's host; without any, the page is one slot.
    """
    blocks = blocks_of(page)
    template = [False] * len(blocks)
    if rounds:
        roles = tokens_of(blocks)
        for valid in rounds:
            template = [known or role in valid for known, role in zip(template, roles[1:], strict=True)]
            roles = refined(roles, valid)
    wanted = [(main, known, b) for (_, b, keep, main, text), known in zip(blocks, template, strict=True) if text and keep]
    inside = any(main for main, _, _ in wanted)
    return " ".join(b for main, known, b in wanted if not known and (main or not inside))


def _by_role(flat: object) -> dict[int, tuple[int, int, int]]:
    """Role to the three numbers kept with it, from the flat array of a host's row."""
    return {} if flat is None else {r: (a, b, c) for r, a, b, c in np.asarray(flat).reshape(-1, 4).tolist()}


def _met(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (host, salt, ...) with the columns of their host, which are copied to every salt."""
    return rows.join(known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"], "left")


def _flat(*names: str) -> Column:
    return F.flatten(F.collect_list(F.array(*[F.col(n).cast("long") for n in names])))


def page_tokens(pages: DataFrame) -> DataFrame:
    """host, salt, page, tokens (64-bit hashes as bytes) of the distinct pages (host, html) that have tokens."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, page in zip(batch["host"], batch["html"], strict=True):
                tokens = tokens_of(blocks_of(page))
                if len(tokens) > 1:
                    mark = xxhash.xxh64_intdigest(page.encode("utf-8", "replace"))
                    rows.append((host, mark % SALTS, mark - (1 << 63), np.array(tokens, np.int64).tobytes()))
            yield pd.DataFrame(rows, columns=["host", "salt", "page", "tokens"])

    return pages.select("host", "html").mapInPandas(read, "host string, salt int, page long, tokens binary").distinct()


def _roles(row: object, count: int, memo: dict) -> list[int]:
    """Roles of a page (host, tokens, valid_0, ...) after ``count`` rounds."""
    roles = np.frombuffer(row.tokens, np.int64).tolist()
    for i in range(count):
        key = row.host, i
        if key not in memo:
            memo[key] = _by_role(getattr(row, f"valid_{i}"))
        roles = refined(roles, memo[key])
    return roles


def classes(pages: DataFrame, count: int, share: float) -> DataFrame:
    """host, found (role, class, size and pages of every role, flat): the large classes on ``share`` of a host's pages.

    Pages (host, page, tokens, valid_0, ...) of one batch give a row a distinct role: its pages and vector, which are
    added up a host.
    """

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            memo: dict = {}
            sums: dict[tuple[str, int], list[int]] = {}
            for row in batch.itertuples(index=False):
                for role, many in Counter(_roles(row, count, memo)).items():
                    entry = sums.setdefault((row.host, role), [0, 0])
                    entry[0] += 1
                    entry[1] ^= xxhash.xxh64_intdigest(struct.pack("<qq", row.page, many)) - (1 << 63)
            yield pd.DataFrame([(h, r, n, v) for (h, r), (n, v) in sums.items()], columns=["host", "role", "pages", "vector"])

    counted = pages.drop("salt").mapInPandas(vectors, "host string, role long, pages long, vector long")
    added = materialize(
        counted.groupBy("host", "role").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector")).where("pages > 1")
    )
    every = added.where(F.col("role") == START).select("host", F.col("pages").alias("all_pages"))
    frequent = added.join(every.where(F.col("all_pages") >= LEAST_PAGES), "host").where(F.col("pages") >= F.col("all_pages") * share)
    large = frequent.groupBy("host", "vector", "pages").agg(F.collect_list("role").alias("roles"), F.count("*").alias("size"))
    members = large.where(F.col("size") >= LEAST_TOKENS).select("host", F.explode("roles").alias("role"), "vector", "size", "pages")
    return members.groupBy("host").agg(_flat("role", "vector", "size", "pages").alias("found"))


def valid_classes(pages: DataFrame, count: int) -> DataFrame:
    """host, valid_<count> (role, class, rank and size of every role, flat): classes of ``found`` that are ordered and nested."""

    def tests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            memo: dict = {}
            held: dict[str, dict[int, tuple[int, int, int]]] = {}
            ranks: dict[tuple[str, int, int], tuple[int, int]] = {}
            crossed = set()
            for row in batch.itertuples(index=False):
                if row.host not in held:
                    held[row.host] = _by_role(row.found)
                found = held[row.host]
                ranked, crossing = tested(_roles(row, count, memo), found)
                for role, (low, high) in ranked.items():
                    key = row.host, found[role][0], role
                    before = ranks.get(key, (low, high))
                    ranks[key] = min(before[0], low), max(before[1], high)
                crossed |= {(row.host, *pair) for pair in crossing}
            rows = [(h, c, r, None, low, high) for (h, c, r), (low, high) in ranks.items()]
            rows += [(h, c, None, rival, 0, 0) for h, c, rival in crossed]
            frame = pd.DataFrame(rows, columns=["host", "class", "role", "rival", "low", "high"])
            yield frame.astype({"role": "Int64", "rival": "Int64"})

    kept = pages.where("found is not null").drop("salt")
    results = kept.mapInPandas(tests, "host string, class long, role long, rival long, low long, high long")
    results = materialize(results.groupBy("host", "class", "role", "rival").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    ranked = results.where("rival is null")
    ordered = (
        ranked.groupBy("host", "class")
        .agg(F.count("*").alias("size"), F.bool_and((F.col("low") == F.col("high")) & (F.col("low") >= 0)).alias("ordered"))
        .where("ordered")
        .drop("ordered")
    )
    rivals = ordered.select("host", F.col("class").alias("rival"))
    crossed = results.where("rival is not null").select("host", "class", "rival").join(rivals, ["host", "rival"], "left_semi")
    valid = ordered.join(crossed, ["host", "class"], "left_anti")
    members = ranked.select("host", "class", "role", F.col("low").alias("rank")).join(valid, ["host", "class"])
    return members.groupBy("host").agg(_flat("role", "class", "rank", "size").alias(f"valid_{count}"))


def templates(pages: DataFrame, share: float = 0.5) -> DataFrame:
    """host, valid_0, ...: the valid classes of each round over the distinct pages (host, html) of a host.

    A class of ``LEAST_TOKENS`` or more on at least ``share`` of a host's pages is tested; such classes are few, as every
    page holds them.  The pages' tokens are written once and read by every step.
    """
    tokens = materialize(page_tokens(pages))
    known = tokens.select("host").distinct()
    for count in range(ROUNDS):
        read = _met(tokens, known) if count else tokens
        found = materialize(classes(read, count, share))
        valid = valid_classes(_met(read, found), count)
        known = materialize(valid if not count else known.join(valid, "host", "left"))
    return known


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html, ...); other columns are ignored.

    NULL or empty html gives the empty text.  A NULL url belongs to the empty host.  Rows that repeat a
    page_id are extracted each; equal pages of a host count once for its template.
    """
    hosted = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        host_of(F.col("url")).alias("host"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    known = templates(hosted)
    salted = hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int"))

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            memo: dict[str, list] = {}
            found = []
            for row in batch.itertuples(index=False):
                if row.host not in memo:
                    flat = [getattr(row, f"valid_{i}") for i in range(ROUNDS)]
                    memo[row.host] = [_by_role(f) for f in flat] if flat[0] is not None else []
                found.append(main_text(row.html, memo[row.host]))
            batch["text"] = found
            yield batch[["page_id", "url", "text"]]

    return _met(salted, known).drop("salt").mapInPandas(texts, "page_id long, url string, text string")
