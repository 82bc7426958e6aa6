"""Main text of web pages by two-pass block rules.

A page is read once into blocks: the text between two block tags, with its share of linked characters, whether it stands in
the page's article, and whether it stands in something that is no article text by its tag (menus, footers, forms,
scripts ...), its role or its class or id (advert, sidebar, comments ...: any word outside the article, whole names inside); those
blocks are left out.

First pass, each block by itself: mostly linked text is bad; else stop-word density and length decide between good, near good
and bad, and blocks of few characters stay open. Standing in an article is a prior: it lifts near good to good, bad to
near good and bad short blocks to open, and a heading is never bad for its links. Second pass: near good blocks become good beside
a good one; open blocks take the label of their nearest decided neighbours (where both sides differ, the nearer one's; at
equal distance, good only beside a good heading or text before); in an article both are bad only between two bad ones. Where
a page marks an article with text, neighbours are those on the same side of its border, and outside near good blocks
without any decided neighbour are bad.

White space in a block becomes one space; blocks are joined by one line feed; nothing else is dropped or cut. Null or empty html, and
pages without main text, give an empty text; an empty table gives no rows. Repeated rows, with or without page_id, are read alike;
columns besides page_id, url and html are left aside. Unclosed tags, comments and quotes are read as far as
they go; the time is linear in the length.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Fixed lists: tags that bound blocks, tags whose content is no article text, raw-text tags, tags without an end.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
OUT = frozenset("nav footer aside form head menu noscript select button svg iframe dialog template object canvas audio video fieldset datalist map".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of a class or id that tell that an element is no article text.
HINTS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsored promo promos promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments commentlist reply replies respond discussion disqus share sharing social related recommended recommendations pagination pager login searchbox searchform toolbar skiplink copyright disclaimer".split())
#: Frequent words of English, French, Spanish and German.
STOP = frozenset("a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on one or other our she so some than that the their them there they this to was we were what when which who will with would you your au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me mon ne nos nous on ou par pas pour qu que qui sa se ses son sur te tu un une vous al como con cual del donde el ella ellas ellos era es esta este fue ha hasta hay las lo los mas mi muy nada o para pero poco por porque quien sin sobre su sus también tiene todo una y ya aber alle als am auch auf aus bei bin bis da das dass dem den denn der die dies doch dort du durch ein eine einem einen einer er es für hat hier ich ihr im ist ja kann man mit nach nicht noch nur oder ohne sein sich sie sind so über um und uns unter vom von vor war was wenn wer wie wir zu zum zur".split())
#: An open block has fewer characters; a long one more.
SHORT, LONG = 70, 200
LINKED, SOME, MANY = 0.5, 0.15, 0.3
_NAME = re.compile(r"/?([a-zA-Z][^\s/<>]*)")
_QUOTED = re.compile(r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>")
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?(?=[\s/>\"']|$)", re.I)
_WORDS = re.compile(r"[a-z]+")
#: Words that may stand beside those in a class or id inside an article.
PLAIN = frozenset("area bar block bottom box button buttons container form group holder inner item items left link links list panel post posts right row section slot thread top unit wrap wrapper".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table select div section article main body nav aside footer header form".split())


class _Block:
    __slots__ = ("heading", "linked", "main", "parts")

    def __init__(self, main: bool, heading: bool):
        self.parts, self.linked, self.main, self.heading = [], 0, main, heading


def _hinted(value: str, inside: bool) -> bool:
    """Whether a class or id tells that an element is no article text. Outside an article any of its words may tell; inside,
    a whole name must consist of such words (comment-list), as articles name their own parts too (related-work, discussion)."""
    if not inside:
        return not HINTS.isdisjoint(_WORDS.findall(value))
    for name in value.split():
        own = [w for w in _WORDS.findall(name) if w not in PLAIN]
        if own and HINTS.issuperset(own) and own != ["discussion"]:
            return True
    return False


def _attributes(raw: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element's attributes tell that it is no article text; that it holds the article."""
    out = main = False
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            out |= _hinted(value, inside)
        elif name == "role":
            out |= value in ROLES
            main |= value == "main"
        elif name == "itemprop":
            main |= value == "articlebody"
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            out = True
    return out, main


def blocks_of(page: str) -> list[_Block]:
    """The blocks of a page that no tag, role, class or id excludes."""
    done: list[_Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, excludes, holds the article, is a link
    places: dict[str, list[int]] = {}  # where each tag's open elements stand in the stack
    out = main = link = heading = 0
    current = _Block(False, False)
    plain_ends = False
    lower = page.lower()
    if len(lower) != len(page):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), page)

    def end_block():
        nonlocal current
        if current.parts:
            done.append(current)
        current = _Block(main > 0, heading > 0)

    def text(raw: str):
        if out or not raw:
            return
        t = entities.unescape(raw) if "&" in raw else raw
        if not current.parts:
            if not t.strip():
                return
            current.main, current.heading = main > 0, heading > 0
        current.parts.append(t)
        if link:
            current.linked += len(t.strip())

    def pop():
        nonlocal out, main, link, heading
        tag, o, m, a = stack.pop()
        places[tag].pop()
        out, main, link = out - o, main - m, link - a
        heading -= tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        if tag in BLOCK:
            end_block()

    pos, n = 0, len(page)
    while pos < n:
        k = page.find("<", pos)
        if k < 0:
            text(page[pos:])
            break
        text(page[pos:k])
        if page.startswith("<!--", k):
            e = page.find("-->", k + 4)
            pos = n if e < 0 else e + 3
            continue
        if page.startswith(("<!", "<?"), k):
            e = page.find(">", k)
            pos = n if e < 0 else e + 1
            continue
        m = _NAME.match(page, k + 1)
        if not m:
            text("<")
            pos = k + 1
            continue
        q = None if plain_ends else _QUOTED.match(page, m.end())
        if q:
            e = q.end()
        else:
            e = page.find(">", m.end()) + 1
            plain_ends = plain_ends or e == 0 or '"' in page[m.end() : e] or "'" in page[m.end() : e]
            if e == 0:
                break
        tag, closing = m[1].lower(), page[k + 1] == "/"
        raw = page[m.end() : e - 1]
        pos = e
        if closing:
            if places.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in BLOCK:
                end_block()
            continue
        if tag in RAW:
            z = lower.find("</" + tag, pos)
            pos = n if z < 0 else z
            if tag in BLOCK:
                end_block()
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCK:
            closes = _CLOSES.get(tag)
            if closes:
                d = max((places[x][-1] for x in closes if places.get(x)), default=-1)
                if d > max((places[x][-1] for x in _SCOPE if places.get(x)), default=-1):
                    while len(stack) > d:
                        pop()
            elif places.get("p") and places["p"][-1] == max(places[x][-1] for x in BLOCK if places.get(x)):  # a block ends an open paragraph
                d = places["p"][-1]
                while len(stack) > d:
                    pop()
            end_block()
        if tag in VOID or raw.endswith("/") and tag not in BLOCK:
            continue
        o, holds = _attributes(raw, main > 0) if raw.strip() else (False, False)
        o = (o and tag not in ("html", "body", "article", "main")) or tag in OUT or (tag == "header" and not main)
        holds = holds or tag in ("article", "main")
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, o, holds, tag == "a"))
        out, main, link = out + o, main + holds, link + (tag == "a")
        heading += tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    end_block()
    return done


def _first(text: str, b: _Block) -> str:
    share = b.linked / max(1, len(text))
    if share > LINKED and not (b.main and b.heading):
        return "bad"
    if len(text) < SHORT:
        return "bad" if share > 0 and not b.main else "open"
    ws = text.lower().split()
    density = sum(w.strip(".,;:!?()\"'") in STOP for w in ws) / max(1, len(ws))
    if density >= MANY:
        return "good" if len(text) > LONG or b.main else "near"
    if density >= SOME:
        return "good" if b.main else "near"
    return "near" if b.main else "bad"


def _second(labels: list[str], got: list[tuple[str, _Block]], prior: bool | None) -> list[str]:
    """Final labels of blocks of one side; prior: whether that is an article's (None: no article on the page)."""
    n = len(labels)
    # near good blocks: good unless both decided neighbours are bad
    before, last = [None] * n, None
    for i in range(n):
        before[i] = last
        last = labels[i] if labels[i] in ("good", "bad") else last
    after, last = [None] * n, None
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = labels[i] if labels[i] in ("good", "bad") else last

    def settled(a, b):
        if prior:
            return "bad" if a == b == "bad" else "good"
        if a is None and b is None:
            return "good" if prior is None else "bad"
        return "bad" if {a, b} <= {"bad", None} else "good"

    labels = [settled(before[i], after[i]) if x == "near" else x for i, x in enumerate(labels)]
    left, right = [None] * n, [None] * n
    for seq, to in ((range(n), left), (range(n - 1, -1, -1), right)):
        at = None
        for i in seq:
            to[i] = at
            at = i if labels[i] != "open" else at
    final = list(labels)
    for i, x in enumerate(labels):
        if x == "open":
            a, b = left[i], right[i]
            near = [j for j in (a, b) if j is not None]
            if prior:
                final[i] = "bad" if len(near) == 2 and labels[a] == labels[b] == "bad" else "good"
            elif not near:
                final[i] = "bad"
            elif len({labels[j] for j in near}) == 1:
                final[i] = labels[near[0]]
            elif i - a != b - i:
                final[i] = labels[a] if i - a < b - i else labels[b]
            else:
                final[i] = "good" if labels[a] == "good" or got[i][1].heading else "bad"
    return final


def main_text(page: str | None) -> str:
    got = [(" ".join("".join(b.parts).split()), b) for b in blocks_of(page or "")]
    got = [(t, b) for t, b in got if t]
    labels = [_first(t, b) for t, b in got]
    marked = any(b.main for _, b in got)
    for side in (True, False):
        own = [i for i, (_, b) in enumerate(got) if b.main == side]
        for i, x in zip(own, _second([labels[i] for i in own], [got[i] for i in own], side if marked else None)):
            labels[i] = x
    return "\n".join(t for (t, _), x in zip(got, labels) if x == "good")


def extractor(spark):
    """A column function from html to main text."""
    bounded_batches(spark)

    def run(page: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in page], pa.string())

    return F.arrow_udf(run, "string")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages."""
    x = pages.select("page_id", "url", extractor(pages.sparkSession)(F.col("html").cast("string")).alias("text"))
    return x.withColumn("n_chars", F.char_length("text").cast("bigint"))
