"""Main text of pages by consensus of a host's container paths.

Each page is cut into blocks; a block belongs to the path of its containers, written as tag.class steps with digits
generalised. Page furniture (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, scripts) is
left out, unless what is named like it wraps the page's text. A page votes for its lowest container that holds COVER of
its text, less links; votes are summed per host and path in Spark. A page is extracted by the path of most votes among
those that hold COVER of it too, else by its own; what stands beside that path in its article belongs to it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/><]*)", re.S)
_PLAIN = re.compile(r"[^>\"']*")
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: Elements whose content isn't markup of the page.
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in "script style noscript template textarea title iframe svg math object".split()}

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a block; all others stand within a line.
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul head option select".split()
)
#: Blocks that hold text themselves: their parent is the container.
LEAF = set("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption td th summary address ul ol dl table tbody tr thead tfoot figure".split())
DROPPED = set("nav header footer aside form button select option menu dialog fieldset head label input canvas audio video".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog menu menubar form alert".split())
#: Words that name page furniture, and words that say no more than that something is a part of a page. A class or id
#: names furniture by its last word that says something, or by its first one if the others say nothing or name it too:
#: site-footer and comment-list do, related-work and notice-period don't.
FURNITURE = re.compile(
    r"(?:ad|ads|adv|advert\w*|adsense|adbox|adslot|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notice\w*|notification\w*|alert\w*|popup|modal|overlay"
    r"|newsletter|subscri\w*|signup|login|share|sharing|social\w*|related|recommend\w*|sidebar\w*|widget\w*|menu\w*|nav|navbar|navigation|breadcrumb\w*|pagination|pager"
    r"|comment\w*|disqus\w*|respond|replies|reply|footer\w*|header|masthead|topbar|copyright|toolbar|search\w*|form)$",
    re.I,
)
PARTS = set(
    "box list links link area block section container wrapper wrap bar posts articles content contents inner outer item items group row col column left right top bottom main slot unit panel text message"
    " title heading label button buttons icon icons strip zone region toggle card cards feed count thread body head side skip".split()
)


def furniture(names: str) -> bool:
    """Whether any of the class names and ids names page furniture."""
    for name in names.lower().split():
        words = [w for w in re.split(r"[\d_-]+", name) if w]
        said = [w for w in words if w not in PARTS]
        if said and (FURNITURE.match(said[-1]) if words[-1] == said[-1] else FURNITURE.match(said[0]) and all(map(FURNITURE.match, said))):
            return True
        if words in (["side", "bar"], ["skip", "link"], ["skip", "links"]):
            return True
    return False


#: Wrappers of reader comments hold no article, however long.
COMMENTS = re.compile(r"comment|disqus|respond|repl(?:y|ies)", re.I)
#: Least share of a page's text that a container holds; that a wrapper named like furniture holds to be kept, by itself or
#: with the page's first heading or main element.
COVER, WRAPS, WRAPS_HEAD = 0.9, 0.9, 0.5
#: Bytes of all hosts' paths that may go to every task; replicas of each path if there are more.
BROADCAST_BYTES, SALTS = 8 << 20, 32
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
#: Tags that an opening tag closes, as HTML leaves end tags out.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def blocks(html: str) -> list[tuple[str, str, int]]:
    """(container path, text, characters in links) of each block of content, in page order."""
    kept: set[int] = set()
    while True:
        out, more = _blocks(html, kept)
        if not more:
            return out
        kept |= more


def _blocks(html: str, spared: set[int]) -> tuple[list[tuple[str, str, int]], set[int]]:
    """The blocks, and the places of elements dropped for their names alone that hold most of the page; those at the
    places spared aren't dropped."""
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str, bool, int]] = []  # tag, step, whether its content is dropped, place if for a name alone
    named: dict[int, list] = {}  # characters, whether a heading or main element is there, whether comments
    shown = 0
    text: list[str] = []
    links = 0
    in_link = 0

    def path() -> str:
        return "/".join(step for tag, step, *_ in stack if tag in BLOCK and tag not in LEAF)

    def flush() -> None:
        nonlocal links
        if text:
            joined = _SPACE.sub(" ", unescape("".join(text))).strip()
            if joined:
                out.append((path(), joined, min(links, len(joined))))
            text.clear()
        links = 0

    def pop(until: int) -> None:
        nonlocal in_link
        while len(stack) > until:
            in_link -= stack.pop()[0] == "a"

    at, n = 0, len(html)
    broken = False  # a tag ran to the end of the page: from there on quotes don't count, so that none is sought again

    def tag_end(start: int) -> int:
        """The place of the > that closes the tag, outside of quotes; -1 if there is none."""
        nonlocal broken
        i = start
        while not broken:
            i = _PLAIN.match(html, i).end()
            if i < n and html[i] == ">":
                return i
            i = html.find(html[i], i + 1) + 1 if i < n else 0
            broken = not i
        return html.find(">", start)

    while at < n:
        m = _TOKEN.search(html, at)
        end = tag_end(m.end()) if m and m["tag"] else -1
        if m and m["tag"] and end < 0:
            m = None  # no tag closes any more: the rest is text
        piece = html[at : m.start() if m else n]
        if piece and not (stack and stack[-1][2]):
            text.append(piece)
            links += len(piece) * (in_link > 0)
            shown += len(piece.strip())
        elif piece and stack[-1][3] >= 0:
            named[stack[-1][3]][0] += len(piece.strip())
        if not m:
            break
        if not m["tag"]:
            at = m.end()
            continue
        at = end + 1
        tag, given = m["tag"].lower(), html[m.end() : end]
        if tag in RAW and not m["close"]:
            over = RAW[tag].search(html, at)
            at = over.end() if over else n
            continue
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag in BLOCK:
                        flush()
                    pop(i)
                    break
                if tag not in BLOCK and stack[i][0] in BLOCK:
                    break  # an inline end tag doesn't close blocks
            continue
        if tag in BLOCK or tag == "br" or tag == "hr":
            flush()
        if tag in VOID:
            continue
        shut = CLOSES.get(tag, ())
        if tag in BLOCK:
            # a block ends open inline elements and an open paragraph
            keep = len(stack)
            while keep and (stack[keep - 1][0] not in BLOCK or stack[keep - 1][0] == "p" or stack[keep - 1][0] in shut):
                keep -= 1
            pop(keep)
        around, by_name = bool(stack and stack[-1][2]), False
        # An article's own header holds its heading.
        own_header = tag == "header" and any(t in ("article", "main") for t, *_ in stack)
        dropped = around or (tag in DROPPED and not own_header)
        step = tag
        if "=" in given or "hidden" in given:
            attrs = {a.lower(): x or y or z or "" for a, x, y, z in _ATTR.findall(given)}
            names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
            if tag not in ("html", "body", "article", "main"):
                dropped = dropped or attrs.get("role", "").lower() in ROLES
                dropped = dropped or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
                by_name = not dropped and m.start() not in spared and furniture(names)
                if by_name:
                    named[m.start()] = [0, False, bool(COMMENTS.search(names))]
            first = attrs.get("class", "").split()[:1] or attrs.get("id", "").split()[:1]
            step = f"{tag}.{_DIGITS.sub('#', first[0].lower())}" if first else tag
        if not given.endswith("/") or tag in BLOCK:
            # Inside of what is dropped for its name, only that counts; other reasons drop what they hold for good.
            own = (tag in DROPPED and not own_header) or (dropped and not around)
            place = m.start() if by_name else stack[-1][3] if around and not own else -1
            if place >= 0 and tag in ("h1", "main"):
                named[place][1] = True
            stack.append((tag, step, dropped or by_name, place))
            in_link += tag == "a"
    flush()
    total = shown + sum(n for n, _, comments in named.values() if not comments)
    more = {k for k, (n, head, comments) in named.items() if n and not comments and n >= (WRAPS_HEAD if head else WRAPS) * total}
    return out, more


def container_scores(found: list[tuple[str, str, int]]) -> dict[str, float]:
    """Shares of the page's text less links that stand in each container or one inside it."""
    own: dict[str, float] = defaultdict(float)
    for path, text, links in found:
        own[path] += (len(text) - links) * (1.0 + 0.1 * min(5, text.count(",") + text.count(".")))
    total = sum(own.values())
    score: dict[str, float] = defaultdict(float)
    for path, good in own.items():
        score[""] += good / total if total and path else 0
        steps = path.split("/")
        for i in range(len(steps)):
            score["/".join(steps[: i + 1])] += good / total if total else 0
    return dict(score) if total else {}


def best(scores: dict[str, float]) -> str | None:
    """The lowest container that holds COVER of the text."""
    enough = [p for p, s in scores.items() if s >= COVER - 1e-9]
    return max(enough, key=lambda p: (p.count("/") + bool(p), p)) if enough else None


def within(path: str, container: str) -> bool:
    return not container or path == container or path.startswith(container + "/")


def around(found: list[tuple[str, str, int]], container: str) -> str:
    """The container widened to the article or main element around it; if there is none, to the elements below body
    around it, as long as what stands beside it is text more than links."""
    steps = container.split("/")
    for i in range(len(steps) - 1, -1, -1):
        if steps[i].split(".")[0] in ("article", "main"):
            return "/".join(steps[: i + 1])
    while len(steps) > 1 and steps[-2].split(".")[0] not in ("html", "body"):
        wider = "/".join(steps[:-1])
        beside = [(len(t), links) for p, t, links in found if within(p, wider) and not within(p, "/".join(steps))]
        if 2 * sum(n for _, n in beside) > sum(n for n, _ in beside):
            break
        steps.pop()
    return "/".join(steps)


def chosen(found: list[tuple[str, str, int]], paths: list[str] | None) -> str | None:
    """The first of the host's paths that holds COVER of the page's text, or else the page's own best one; widened."""
    scores = container_scores(found)
    path = next((p for p in paths or () if scores.get(p, 0) >= COVER - 1e-9), None)
    path = best(scores) if path is None else path
    return None if path is None else around(found, path)


def extract(found: list[tuple[str, str, int]], container: str | None) -> str:
    """The blocks within the container."""
    return "\n".join(t for p, t, _ in found if container is not None and within(p, container))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their blocks, and the container that each votes for."""
    for batch in batches:
        every = [blocks(html.as_py() or "") for html in batch.column(3)]
        found = [[{"path": p, "text": t, "links": n} for p, t, n in x] for x in every]
        kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("links", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([best(container_scores(x)) for x in every], pa.string()), pa.array(found, kind)], ["id", "url", "host", "vote", "blocks"]
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): each host's containers by falling votes; ties go by name. Those of a single vote say nothing of
    other pages, and their own page finds them by itself."""
    summed = pages.where("vote is not null").groupBy("host", F.col("vote").alias("path")).agg(F.count("*").alias("votes")).where("votes > 1")
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("votes"), "path")))
    return summed.groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("paths"))


def _with_container(rows: DataFrame) -> DataFrame:
    """rows with their host's containers. The paths are measured: up to BROADCAST_BYTES of them are sent to all tasks, and no page is moved;
    more are joined by host and salt, each path once per salt, so that no host's pages meet in one task."""
    paths = written(host_paths(rows), "hostpaths")
    size = paths.agg(F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", "")) + 64 * F.size("paths"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(paths), "host", "left")
    salted = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("url", "id"), F.lit(SALTS)).cast("int"))
    return spread.join(salted, ["host", "salt"], "left")


def main_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per row of pages: (page_id, url, text, n_chars, host, container).

    Null html counts as empty and gives an empty text. A url without a host, or null, belongs to the host ''. Pages that
    repeat vote once each and all stay. Other columns are ignored; an empty table gives no rows. A line break element
    ends a block as a paragraph does. Whole pages are read and nothing is cut off.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), "url", host.alias("host"), "html")
    # Each page is parsed once; its blocks, mostly its text, are written.
    rows = written(rows.mapInArrow(_parsed, f"id {kind}, url string, host string, vote string, blocks array<struct<path:string,text:string,links:int>>"), "blocks")
    joined = _with_container(rows).select("id", "url", "host", "paths", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, containers = [], []
            for paths, held in zip(batch.column(3), batch.column(4), strict=True):
                found = [(x["path"], x["text"], x["links"]) for x in held.as_py()]
                containers.append(chosen(found, paths.as_py()))
                texts.append(extract(found, containers[-1]))
            cols = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), batch.column(2), pa.array(containers, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "url", "text", "n_chars", "host", "container"])

    return joined.mapInArrow(run, f"`{id_col}` {kind}, url string, text string, n_chars bigint, host string, container string")
