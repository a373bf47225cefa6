"""Main text of web pages by deducing the template of each host.

Tokens are the page itself, its elements, named by their path, and its texts. Tokens that occur
equally often on each page of a host form an equivalence class. Classes of two tokens or more
that hold on half of a host's pages are its template, without the tokens that
change places within their class. A text is constant if its element is in the same class, and
the slot of the article is the template's element that holds most text which is not; an element's
name weighs as well (``_worth``). Elements that are page furniture by their kind or name are
left out before. Occurrence vectors are never laid out: equal vectors have equal hashes,
which are combined in each task before the shuffle.

Copies are not a template. Pages of a host with the same texts count as one, a constant text is on three
of them or more, and constants are only taken out of a page if they are no more than half of its text.
"""

import hashlib
import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from verbalance import session
from verbalance.llm import words
from verbalance.llm.url_filter import host_of

BYTES_AT_ONCE = 4_000_000
# A page whose own text has fewer words, such as a date, is taken for a copy of other pages.
OWN_WORDS = 8

# HTML element names by what they are, and names authors give to page furniture.
SKIPPED = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "select", "title"}
TO_THE_END = {"script", "style"}
STRUCTURE = {
    "html", "head", "body", "header", "footer", "nav", "aside", "main", "article", "section",
    "div", "ul", "ol", "dl", "table", "form", "figure", "fieldset", "menu", "dialog", "button",
    "details", "blockquote", "pre", "center",
}
BLOCKS = STRUCTURE | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "thead",
    "tbody", "tfoot", "caption", "figcaption", "hr", "address", "hgroup", "legend", "summary",
    "option",
}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "wbr"}
FURNITURE = {"head", "nav", "footer", "aside", "menu", "dialog", "button"}
FURNITURE_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "dialog", "alert", "menu", "menubar",
    "toolbar",
}
# Furniture as those in FURNITURE_NAMES are: unless they hold the article or most of a page's text.
FORMS, FORM_ROLES = {"form", "fieldset"}, {"form", "search"}
WHOLE = {"html", "body", "main", "article"}
FURNITURE_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsbygoogle",
    "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent",
    "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup",
    "promo", "promoted", "promotion", "recommended", "related", "replies", "respond", "search",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "topbar", "widget", "widgets",
}
# Those that say little inside an article, where they may name its subject.
OUTSIDE_NAMES = {
    "banner", "consent", "login", "menu", "navigation", "notice", "notices", "promotion",
    "recommended", "related", "replies", "respond", "search", "share", "sharing", "signup", "skip",
    "social", "subscription", "toolbar", "widget", "widgets",
}
CONTENT_NAMES = {"article", "content", "entry", "main", "post", "story", "text"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
_NAME = re.compile(r"[a-z]+")


@words.remembered
def _element(tag, attributes):
    """Name of an element in paths, and whether it is page furniture: by its kind, by its name or as
    a form, and by a name or as a form within an article."""
    names, tokens, hidden, role = [], set(), False, ""
    for key, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), html.unescape(value.strip("\"'")).lower()
        if key == "hidden":
            hidden = tag not in ("html", "body")
        elif key == "role":
            role = value
        else:
            names += _NAME.findall(value)
            tokens.update(value.split())
    kind = role if role in ("main", "article") else tag
    whole = kind in WHOLE
    sure = hidden or not whole and (tag in FURNITURE or role in FURNITURE_ROLES)
    form = tag in FORMS or role in FORM_ROLES
    likely = not whole and (form or not FURNITURE_NAMES.isdisjoint(tokens))
    within = not whole and (form or not FURNITURE_NAMES.difference(OUTSIDE_NAMES).isdisjoint(tokens))
    return ".".join([kind, *sorted(set(names))]), sure, likely, within


def _kept(texts, articles, likely):
    """Elements of ``likely`` that hold the article or most of the page's text, and so are no furniture.

    ``texts`` are ``(elements of likely around it, characters)``; ``articles`` are ``(kind, elements of likely
    around it)`` of the outermost article and main elements; ``likely`` tells forms.
    """
    held, own = Counter(e for _, around in articles for e in around), Counter()
    for around, size in texts:
        for element in around:
            own[element] += size
    total = sum(size for _, size in texts)
    # Several articles without a main may be teasers.
    sole = len(articles) == 1 or any(kind == "main" for kind, _ in articles)
    kept = {
        element
        for element, form in likely.items()
        if held[element] == len(articles)
        and (articles and (form or sole) or 2 * own[element] > total)
    }
    if articles and not any(kept.issuperset(around) for _, around in articles):
        kept.update(held)
    return kept if any(kept.issuperset(around) for around, _ in texts) else set(likely)


def parse(page):
    """Blocks ``(path, furniture, text, elements opened before)`` of a page in order, and the
    paths of its elements.

    An end tag closes the innermost open element of its name; one without any is ignored. Skipped
    elements go up to their end tag; of one without, or self-closed, only the tag is skipped,
    but script and style go on to the end.
    """
    blocks, opened = [], []
    stack = [("", "", False, ())]  # tag, path, furniture, elements around that are likely furniture
    around, articles, likely = [], [], {}
    endless = set()  # skipped elements that have no end tag in the rest of the page
    pieces, at, end = [], 0, len(page)

    def flush():
        if pieces:
            text = _BLANKS.sub(" ", html.unescape("".join(pieces))).strip(" ")
            if text:
                blocks.append((stack[-1][1], stack[-1][2], text, len(opened)))
                around.append(stack[-1][3])
            pieces.clear()

    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            pieces.append(page[at:])
            break
        if tag.start() > at:
            pieces.append(page[at : tag.start()])
        at = tag.end()
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        if name in SKIPPED and not tag.group(1):
            if name not in TO_THE_END and (name in endless or _SELF_CLOSED.search(tag.group(3))):
                continue
            close = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at)
            if close:
                at = close.end()
            elif name in TO_THE_END:
                at = end
            else:
                endless.add(name)
            continue
        if name == "br":
            pieces.append(" ")
        if name not in BLOCKS:
            continue
        flush()
        if name not in STRUCTURE or name in VOID:
            continue
        if tag.group(1):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
        else:
            label, furniture, likely_out, likely_in = _element(name, tag.group(3).strip())
            _, above, inherited, outer = stack[-1]
            maybe = likely_in if _inside_article(above) else likely_out
            path = f"{above}/{label}"
            if name == "header" and not _inside_article(above):
                furniture = True
            furniture = furniture or inherited
            if maybe and not furniture:
                outer = (*outer, len(opened))
                likely[len(opened)] = name in FORMS
            if not furniture and _inside_article(path) and not _inside_article(above):
                articles.append((label.split(".")[0], outer))
            opened.append(path)
            stack.append((name, path, furniture, outer))
    flush()
    if likely:
        texts = [(own, len(b[2])) for b, own in zip(blocks, around) if not b[1]]
        kept = _kept(texts, articles, likely)
        blocks = [
            (path, furniture or not kept.issuperset(own), text, before)
            for (path, furniture, text, before), own in zip(blocks, around)
        ]
    return blocks, opened


def _kinds(path):
    return [label.split(".")[0] for label in path.split("/")]


@words.remembered
def _inside_article(path):
    return not {"article", "main"}.isdisjoint(_kinds(path))


@words.remembered
def _worth(path):
    """How much an element's name speaks for being the article's."""
    kind, *names = path.rsplit("/", 1)[-1].split(".")
    if kind in ("article", "main"):
        return 6.0 if kind == "article" and FURNITURE_NAMES.isdisjoint(names) else 3.0
    return 1.0 if CONTENT_NAMES.isdisjoint([kind, *names]) else 1.5


def _masses(texts):
    """Characters of the texts ``(path, text)`` within each element."""
    masses = {}
    for path, text in texts:
        while path:
            masses[path] = masses.get(path, 0) + len(text)
            path = path.rpartition("/")[0]
    return masses


def _characters(texts):
    return sum(len(text) for _, text in texts)


def _text_token(path, text):
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16)
    return f"{path}\n{digest.hexdigest()}"


def content_of(blocks):
    """A 64-bit hash of a page's texts and where they are, furniture's left out."""
    digest = hashlib.blake2b(digest_size=8)
    for path, furniture, text, _ in blocks:
        if not furniture:
            digest.update(f"{path}\n{text}\n".encode("utf-8", "surrogatepass"))
    return int.from_bytes(digest.digest(), "little", signed=True)


def sequence(blocks, opened):
    """Tokens of a page in order; the empty one stands for the page itself. Furniture's texts are none."""
    yield ""
    at = 0
    for path, furniture, text, before in blocks:
        yield from opened[at:before]
        at = before
        if not furniture:
            yield _text_token(path, text)
    yield from opened[at:]


def measure(blocks, opened, vectors):
    """``token -> (place, mass, varying)`` of a page's tokens that are in ``vectors``.

    ``place`` counts the tokens of its class that begin before it. ``mass`` are the characters of text
    within an element, ``varying`` those of texts that do not share its class with their element.
    """
    texts = [(path, text) for path, furniture, text, _ in blocks if not furniture]
    free = [
        (path, text)
        for path, text in texts
        if path not in vectors or vectors.get(_text_token(path, text)) != vectors[path]
    ]
    masses, varying = _masses(texts), _masses(free)
    masses[""], varying[""] = _characters(texts), _characters(free)
    found, begun = {}, {}
    for token in sequence(blocks, opened):
        if token in vectors and token not in found:
            place = begun.get(vectors[token], 0)
            begun[vectors[token]] = place + 1
            found[token] = place, masses.get(token, 0), varying.get(token, 0)
    return found


def choose_slot(masses):
    """The element whose name and amount of text speak most for it; the innermost of equals."""
    best = max(masses, key=lambda p: (_worth(p) * masses[p], p.count("/")), default="")
    return best


def own_texts(texts, constants):
    """The texts of a page without those of its template; None if too little would be left.

    A template's constants lie outside the elements that hold a page's own text, and go whatever their
    share. Those in or below such an element go as well, unless they are more than half of it:
    then the page is a near copy of others, and they are part of the article.
    """
    own = [(p, t) for p, t in texts if _text_token(p, t) not in constants]
    if sum(len(t.split()) for _, t in own) < OWN_WORDS:
        return None
    holders = {path for path, _ in own}
    whole, varying, known = _masses(texts), _masses(own), {}

    def stays(path):
        if path not in known:
            if path in holders:
                known[path] = 2 * varying.get(path, 0) < whole.get(path, 0)
            else:
                known[path] = bool(path) and stays(path.rpartition("/")[0])
        return known[path]

    return [(p, t) for p, t in texts if _text_token(p, t) not in constants or stays(p)]


def extract(page, template):
    """The text of a page's article; ``template`` is None if the host has none.

    ``template`` is the slot's path and the constant texts. A page without the
    slot, or with a template without one, is read by its own elements, as is one with hardly any
    text of its own, which keeps the constants.
    """
    blocks, opened = parse(page)
    slot, constants = template or ("", ())
    texts = [(path, text) for path, furniture, text, _ in blocks if not furniture]
    own = own_texts(texts, constants) if constants else texts
    if own is None:
        slot, own = "", texts
    if not slot or slot not in opened:
        slot = choose_slot(_masses(own))
    inside = f"{slot}/"
    return "\n\n".join(text for path, text in own if path == slot or path.startswith(inside))


def deduce(members):
    """A template of a host's tokens: ``(slot, constant texts)``.

    ``members`` are dicts of ``token, vector, least, most, mass, varying``; ``least`` and ``most`` are the
    first and last place a token takes within its class. Classes are nested by their paths; an element
    whose parent is in no class hangs on no template and is left out.
    """
    classes = {}
    for member in members:
        if member["least"] == member["most"]:
            classes.setdefault(member["vector"], {})[member["token"]] = member
    classes = {vector: own for vector, own in classes.items() if len(own) > 1}
    elements = {t: m for own in classes.values() for t, m in own.items() if "\n" not in t}
    nested = {}
    for path in sorted(elements, key=lambda p: (p.count("/"), p)):
        if not path or path.rpartition("/")[0] in nested:
            nested[path] = elements[path]
    constants = set()
    for vector, own in classes.items():
        for token in own:
            path, is_text, _ = token.partition("\n")
            if is_text and path in nested and nested[path]["vector"] == vector:
                constants.add(token)
    masses = {p: m["varying"] for p, m in nested.items() if p and m["varying"]}
    return choose_slot(masses), frozenset(constants)


def _emit(batches):
    for whole in batches:
        for start, end in words.slabs(words.text_sizes(whole.column("html")), BYTES_AT_ONCE):
            part = whole.slice(start, end - start).to_pydict()
            columns = [], [], [], []
            for host, text in zip(part["host"], part["html"]):
                blocks, opened = parse(text or "")
                page = content_of(blocks)
                for token, count in Counter(sequence(blocks, opened)).items():
                    for column, value in zip(columns, (host, page, token, count)):
                        column.append(value)
            kinds = pa.string(), pa.int64(), pa.string(), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["host", "page", "token", "times"],
            )


def _by_host(known, part, column, make):
    """``make`` of each row's ``column``, which is read once per host."""
    for row, host in enumerate(part.column("host").to_pylist()):
        if host not in known:
            if len(known) > 10_000:
                known.clear()
            known[host] = make(part.column(column)[row].as_py())
        yield known[host]


def _measure_all(batches):
    known = {}
    for whole in batches:
        for start, end in words.slabs(words.text_sizes(whole.column("html")), BYTES_AT_ONCE):
            part = whole.slice(start, end - start)
            rows = part.select(["host", "html"]).to_pydict()
            columns = [], [], [], [], [], []
            told = _by_host(known, part, "members", lambda own: {m["token"]: m["vector"] for m in own})
            for host, text, vectors in zip(rows["host"], rows["html"], told):
                blocks, opened = parse(text or "")
                page = content_of(blocks)
                for token, values in measure(blocks, opened, vectors).items():
                    for column, value in zip(columns, (host, page, token, *values)):
                        column.append(value)
            kinds = pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["host", "page", "token", "place", "mass", "varying"],
            )


def host_templates(pages):
    """``host, members``: the tokens that half of a host's pages have, with their classes and measures.

    ``pages`` has ``host, html``. Pages of a host with the same texts are one page. An element is on two
    pages or more, as is a text, and both on half of the host's. Tokens of
    one page are left out before anything is joined. What is joined to the pages are a host's few
    tokens; Spark broadcasts them by their size or shuffles the pages, and splits hot hosts.
    """
    spark = pages.sparkSession
    emitted = pages.mapInArrow(_emit, "host string, page bigint, token string, times bigint")
    distinct = emitted.groupBy("host", "page", "token").agg(F.max("times").alias("times"))
    found = distinct.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"),
        F.bit_xor(F.xxhash64("page", "times")).alias("vector"),
    )
    found = session.written(found.where("pages > 1"), session.scratch_path(spark, "html-tokens"))
    hosts = found.where("token = ''").select("host", F.col("pages").alias("of"))
    frequent = found.join(hosts, "host").where("2 * pages >= of")
    classes = session.written(
        frequent.groupBy("host").agg(F.collect_list(F.struct("token", "vector")).alias("members")),
        session.scratch_path(spark, "html-classes"),
    )
    measured = pages.join(classes, "host").select("host", "html", "members")
    measured = measured.mapInArrow(
        _measure_all,
        "host string, page bigint, token string, place bigint, mass bigint, varying bigint",
    )
    measured = measured.groupBy("host", "page", "token").agg(
        F.min("place").alias("least"),
        F.max("place").alias("most"),
        F.max("mass").alias("mass"),
        F.max("varying").alias("varying"),
    )
    measured = measured.groupBy("host", "token").agg(
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("mass").alias("mass"),
        F.sum("varying").alias("varying"),
    )
    members = frequent.join(measured, ["host", "token"])
    names = "token", "vector", "pages", "of", "least", "most", "mass", "varying"
    return members.groupBy("host").agg(F.collect_list(F.struct(*names)).alias("members"))


def _extract_all(batches):
    known = {}
    for whole in batches:
        for start, end in words.slabs(words.text_sizes(whole.column("html")), BYTES_AT_ONCE):
            part = whole.slice(start, end - start)
            told = _by_host(known, part, "members", lambda own: deduce(own) if own else None)
            pages = part.column("html").to_pylist()
            texts = [extract(page or "", template) for page, template in zip(pages, told)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )


def main_text(pages):
    """The article of every page as text.

    ``pages`` needs ``page_id`` (long), ``url`` and ``html``; other columns are ignored. Blocks
    hold one space for each run of ``[\\x20\\x09-\\x0D]`` and are joined by two line feeds; character references are
    decoded. Null or empty html gives an empty text, as does a page with no article. Pages
    without a host are one host; a host with one page has no template and its page
    is read by its own elements; two pages make a template of what both have. Rows with the same
    texts count as one page and keep theirs. A page whose own text has less than ``OWN_WORDS`` words keeps
    what it shares with others. Sections named as furniture stay within an article, but for adverts,
    comments and the like; elsewhere they go.

    Returns ``page_id, url, text, n_chars``.
    """
    spark = pages.sparkSession
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        host_of(F.col("url")).alias("host"),
        "html",
    )
    templates = session.written(
        host_templates(own.select("host", "html")), session.scratch_path(spark, "html-templates")
    )
    joined = own.join(templates, "host", "left")
    return joined.select("page_id", "url", "host", "html", "members").mapInArrow(
        _extract_all, "page_id bigint, url string, text string, n_chars bigint"
    )
