"""Trees of page elements, from markup or from bare lines, and what of them is visible.

Two builders make the same kind of element:

* :func:`render` builds a tree from markup with implied end tags, drops what
  visibility rules hide (scripts, hidden and navigation elements) and emits text
  with block spacing, list bullets and aligned table cells;
* :func:`line_tree` builds it from the lines of a text that has lost its markup. Each
  line implies an element (menu entry, notice, box title, box entry, heading, name,
  list item, table row, paragraph, footer; :func:`elements`) and ends those that can't
  hold it; the same visibility rules hide elements, and the same renderer emits the rest.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from html.parser import HTMLParser

import ahocorasick

# ---------------------------------------------------------------- markup

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset("script style noscript template head title svg nav aside footer form button select iframe object".split())
_BLOCK = frozenset("address article blockquote dd div dl dt fieldset figure h1 h2 h3 h4 h5 h6 header hr li main ol p pre section table tr ul body html".split())
#: An open element of the key's set ends when the key starts.
_IMPLIED = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "thead": {"tr", "td", "th"},
    "tbody": {"tr", "td", "th", "thead"},
} | dict.fromkeys(("p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "section", "article", "pre", "blockquote"), {"p"})
_SCOPE = frozenset("ul ol table dl".split())
_CLASS = re.compile(r"\b(?:nav|menu|cookie|consent|banner|sidebar|footer|breadcrumb|share|promo|ad|ads|hidden|sr-only)\b", re.I)


class Node:
    """An element with attributes and children, which are nodes or strings."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []

    def visible(self) -> bool:
        a = self.attrs
        if not a or (len(a) == 1 and "lines" in a):
            return self.tag not in _HIDDEN
        style = (a.get("style") or "").replace(" ", "").lower()
        return not (self.tag in _HIDDEN or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style or _CLASS.search(f"{a.get('class') or ''} {a.get('id') or ''}"))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        ends = _IMPLIED.get(tag, ())
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in ends:
                del self.open[k:]
            elif self.open[k].tag in _SCOPE or self.open[k].tag not in ("b", "i", "a", "span", "em", "strong"):
                break
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def tree(markup: str) -> Node:
    """The element tree of ``markup``; stray end tags are ignored, open elements end with the text."""
    builder = _Builder()
    builder.feed(markup)
    builder.close()
    return builder.root


def _cells(row: Node) -> list[str]:
    return [" ".join(_text(c).split()) for c in row.children if isinstance(c, Node) and c.tag in ("td", "th") and c.visible()]


def _table_rows(node: Node) -> list[list[str]]:
    rows = []
    for c in node.children:
        if isinstance(c, Node) and c.visible():
            rows.extend([_cells(c)] if c.tag == "tr" else _table_rows(c))
    return rows


def _text(node: Node, depth: int = 0) -> str:
    out: list[str] = []
    for n, c in enumerate(node.children):
        if isinstance(c, str):
            out.append(c if node.tag == "pre" else re.sub(r"[ \t\r\n]+", " ", c))
        elif c.tag == "br":
            out.append("\n")
        elif not c.visible():
            continue
        elif c.tag == "table":
            rows = [r for r in _table_rows(c) if r]
            widths = [max(len(r[k]) for r in rows if k < len(r)) for k in range(max(map(len, rows), default=0))]
            out.append("\n\n" + "\n".join("  ".join(v.ljust(w) for v, w in zip(r, widths, strict=False)).rstrip() for r in rows) + "\n\n")
        elif c.tag == "li":
            mark = f"{1 + sum(isinstance(x, Node) and x.tag == 'li' for x in node.children[:n])}. " if node.tag == "ol" else "- "
            out.append("\n" + "  " * depth + mark + _text(c, depth + 1).strip())
        elif c.tag in ("ul", "ol"):
            out.append(_text(c, depth) if depth else "\n" + _text(c, depth) + "\n")
        elif c.tag in _BLOCK:
            out.append("\n\n" + _text(c, depth).strip("\n ") + "\n\n")
        else:
            out.append(_text(c, depth))
    return "".join(out)


def render(markup: str | None) -> str:
    """Visible text of ``markup`` with blocks apart, bulleted lists and aligned tables."""
    if not markup:
        return ""
    return tidy(_text(tree(markup)))


# ---------------------------------------------------------------- bare lines

# Labels of site menus in four languages.
MENU = frozenset(
    """home|start|news|events|people|directory|about|about us|contact|search|login|log in|sign in|library|careers|jobs|alumni|give|giving|apply|
admissions|research|teaching|study|a-z index|a to z|site map|sitemap|visit the campus|undergraduate study|graduate programmes|faculty and staff|students|staff|
startseite|aktuelles|personen|kontakt|suche|suchen|anmelden|bibliothek|stellenangebote|karriere|forschung|lehre|studium|über uns|
accueil|actualités|personnes|annuaire|contact|recherche|rechercher|connexion|bibliothèque|emplois|enseignement|études|à propos|plan du site|qui sommes-nous|
inicio|noticias|personas|contacto|buscar|acceder|biblioteca|empleo|investigación|docencia|estudios|quiénes somos|mapa web|directorio|acceso|ingresar|publicaciones|donar|dons|spenden""".replace("\n", "").split("|")
)

# Titles of side boxes, by what their entries look like.
BOXES = {
    "links": "quick links|useful links|resources|in this section|related links|links|on this page|downloads|weitere links|liens utiles|enlaces",
    "people": "related people|people in this unit|see also|colleagues|similar profiles|other members|team members|ansprechpartner|siehe auch|voir aussi|véase también",
    "news": "latest news|headlines|in the news|news|from the magazine|featured story|elsewhere on campus|upcoming events|events|announcements|aktuelles|actualités|noticias",
    "contact": "need help?|contact us|department office|visit us|office|get in touch|help desk|questions?|kontakt|contactez-nous|contacto",
    "other": "popular searches|sponsored|advertisement|anzeige|publicité|publicidad|poll of the week|opening hours|weather|weather today|weather on campus|trending|tags|most read",
}
_BOX = {t: kind for kind, titles in BOXES.items() for t in titles.split("|")}

# Phrases that notices, prompts and footers of any site use. A line is
# tried against the expressions only if it holds one of the stems (lower case). What a
# site words in its own way is told by its recurrence instead (:mod:`lectern.llm.templates`).
_CUES = [
    ("cookie", r"\bcookies?\b"),
    ("javascript|your browser|scripts", r"\bjavascript\b|your browser is (?:old|outdated|not supported)|(?:enable|need|turn on|without) scripts"),
    ("privacy|accept all|allow all|reject all|third parties|datenschutz|einverstanden|tout accepter|aceptar todo", r"\bprivacy (?:policy|notice|statement|matters)\b|\b(?:accept|allow|reject) all\b|third parties|datenschutz|einverstanden|tout accepter|aceptar todo"),
    ("skip |jump to", r"^(?:skip|jump) (?:to|navigation)"),
    ("share this|email this|print this|copy link|cette page|esta página|diese seite", r"(?:share|email|print) this (?:page|profile|article)|copy link to|(?:partage[rz]|imprimer?) cette page|(?:comparta|imprimir) esta página|diese seite (?:drucken|teilen|weiter)"),
    ("follow |folgen sie|suivez|siga a|síganos", r"^follow .{2,60} on (?:your|our|social|all)\b|folgen sie|suivez|siga a\b|síganos"),
    ("subscribe|newsletter|abonnez|abonnieren|suscríba", r"subscribe to|newsletter|abonnez-vous|abonnieren|suscríbase"),
    ("donate|make a gift|with a gift|faites un don|spenden|donativo|soutenez", r"\bdonate\b|(?:make|with) a gift|faites un don|\bspenden\b|donativo|\bsoutenez\b"),
    ("article continues|continues below|advertisement|editor's note|hinweis der redaktion|note de la rédaction|nota de la redacción", r"article continues|continues below|advertisement\b|^(?:editor's note|hinweis der redaktion|note de la rédaction|nota de la redacción)\b"),
    ("report a|accessibility|une erreur|algún dato|stimmt etwas|fehler", r"report an? (?:accessibility|error|problem)|^accessibility\b.{0,30}$|une erreur sur|algún dato erróneo|stimmt etwas nicht|fehler (?:auf|in) diese"),
    ("©|(c)|copyright|rights reserved|rechte vorbehalten|droits réservés|derechos reservados", r"^(?:©|\(c\)|copyright)|all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos"),
    ("views on this page|equal opportunity|not discriminate", r"views on this page|equal opportunity|does not discriminate"),
    ("webmaster|maintained by|content owner|last edited|last updated|last modified|last review|powered by|zuletzt geändert|mise à jour|última actualización|gepflegt|gérée|mantenida", r"^webmaster\b|page (?:maintained|managed) by|content owner|last (?:edited|updated|modified|review)|^powered by|zuletzt geändert|dernière mise à jour|última actualización|seite gepflegt|page gérée|página mantenida"),
    ("sitemap|terms|imprint|impressum|mentions légales|aviso legal", r"^sitemap\b|^(?:terms|imprint)\b.{0,40}$|impressum|mentions légales|aviso legal"),
    ("→|read on|more ...|[more]|[mehr]|[plus]|[más]", r"(?:→|\bread on|\bmore \.\.\.|\[more\]|\[mehr\]|\[plus\]|\[más\])\s*$"),
    ("info@|office@|admissions@|reception@|helpdesk@|webmaster@", r"^(?:info|office|admissions|reception|helpdesk|webmaster)@\S+$"),
]
_CUE = re.compile("|".join(f"(?:{c})" for _, c in _CUES), re.I)
#: Whole lines that are tools of a page.
_TOOL = re.compile(
    r"^(?:toggle navigation|menu|navigation|back to top|top|close|show (?:less|more)|view all|read more|load more|expand all|print|share|tweet|email page|rate this page|download vcard|add to favourites|like|ok|yes, fine|no, thanks|allow selection|consent|details|statistics|settings|manage choices|about cookies|more|weiter|nach oben|haut de page|subir|mehr erfahren|weiterlesen|más información|leer más|en savoir plus|lire la suite|ver todo|alle anzeigen|tout afficher|de acuerdo)\W*$",
    re.I,
)


def _automaton(stems: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for stem in stems:
        a.add_word(stem, 1)
    a.make_automaton()
    return a


_STEMS = _automaton([stem for stems, _ in _CUES for stem in stems.split("|")])


#: Positions and titles, in lower case, without which ``_POSITION`` finds nothing.
_POSITION_STEMS = _automaton(
    "professor lecturer instructor scientist fellow reader researcher director dean chair emeritus dozent professur wissenschaftliche maître chercheu professeur profesor investigador catedrátic".split()
)
#: Letters that are others to ``lower`` than to expressions that ignore case.
_ODD_CASE = re.compile("[ſıİ]")


def cued(line: str) -> bool:
    """Whether a line is a notice, prompt, footer or teaser by its wording."""
    if len(line) < 32 and _TOOL.match(line):
        return True
    return next(_STEMS.iter(line.lower()), None) is not None and _CUE.search(line) is not None


#: Placeholders that a template left between the paragraphs.
_MARKER = re.compile(
    r"^\W{0,3}(?:%%[^%]+%%|\$\{[^}]+\}|\{\{[^}]+\}\}|\{%[^%]+%\}|\[\[[^\]]+\]\]|<(?:add|insert|put|place|your|name|todo)\b[^>]*>|\[(?:insert|add|put|your|placeholder|todo|image|caption|photo)\b[^\]]*\]|(?:todo|fixme|tbd|tbc|xxx)\b.*|<!--.*-->|lorem ipsum.*|-+ ?(?:text|content) to follow ?-+|#(?:name|ref|value|n/a)[?!]?|\[object object\]|undefined(?:, undefined)*|null|nan)\W{0,3}$",
    re.I,
)
_POSITION = re.compile(
    r"\b(?:professor|lecturer|instructor|scientist|fellow|reader|researcher|director|dean|chair|emeritus|dozent\w*|professur|wissenschaftliche\w*|maître|maîtresse|chercheu\w+|professeure?|profesora?|investigadora?|catedrátic\w+)\b",
    re.I,
)


def has_position(s: str) -> bool:
    """Whether ``_POSITION`` is found; it is tried only if the line holds one of its stems."""
    return (next(_POSITION_STEMS.iter(s.lower()), None) is not None or not s.isascii() and _ODD_CASE.search(s) is not None) and _POSITION.search(s) is not None


_INSTITUTION = re.compile(r"\b(?:university|universität|universidad|université|college|institute of technology|hochschule|state university|medical school|école)\b", re.I)
_ADDRESS_FOOT = re.compile(r"^[^\d|,]{4,70}\s?[|,]\s.*\d")
_PUBLISHED = re.compile(r"\bdoi:|\(\d{4}\)|[“”]")
_CRUMB = re.compile(r"^[^.!?;:]{2,60}(?:\s(?:»|›|>|::|/|→)\s[^.!?;:]{1,60})+$")
_TEASER = re.compile(r"^(?!The )[^\W\d]\w{2,}(?: (?:report|weekly|news|today|monthly|daily))?\s?(?::| -| –) \S")
#: What a breadcrumb has between its parts.
_CRUMB_MARK = re.compile(r"»|›|>|/|→|::")
_COLUMNS = re.compile(r"\s\|\s|\s{2,}")
_BULLET = re.compile(r"^[\s]*(?:[›>»*•·–-])\s+")
_WORDS = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_DEGREES = frozenset("prof professor dr doctor phd md mr mrs ms assoc assistant jr sr ii iii iv faas msc bsc ma dphil emeritus ing habil".split())


def folded(s: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))


def name_words(s: str) -> list[str]:
    """Folded words of a name without titles, degrees and initials."""
    return [w for w in (folded(w) for w in _WORDS.findall(s)) if len(w) > 1 and w not in _DEGREES]


def alike(a: str, b: str) -> bool:
    """Equal but for one edit or swap in words of six letters and more."""
    if a == b:
        return True
    if min(len(a), len(b)) < 6 or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i + 1 :] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])


@lru_cache(maxsize=50_000)
def _looks_name(line: str) -> bool:
    if len(line) >= 70:
        return False
    found = _WORDS.findall(line)
    return 1 <= len(found) <= 7 and not re.search(r"\d|[|/:;!?]", line) and len(line) < 70 and sum(w[0].isupper() for w in found) >= 0.6 * len(found)


HIDDEN_KINDS = frozenset({"menu", "crumb", "notice", "marker", "box", "footer", "head"})
_NO_RECURRENCE: frozenset[int] = frozenset()
_YEARS = re.compile(r"\b(?:19|20)\d\d\b")
_CALL = re.compile(r"^(?!The )[^\W\d][^:.!?]{2,40}: \S")
_MORE = re.compile(r"(?:→|\bread on|\bmore \.\.\.|\[more\])\s*$")


def elements(text: str, own: list[str] | None = None, recurrent: frozenset[int] | set[int] = _NO_RECURRENCE) -> list[tuple[int, str]]:
    """(line number, kind) of each line that isn't blank.

    ``own`` are the folded words of the name of the page's person, which tell the
    person's line from those of colleagues; ``recurrent`` are the numbers of lines that
    recur on other pages of the site or on other sites.
    """
    own = own or []
    raw = text.split("\n")
    at = [n for n, s in enumerate(raw) if s.strip("﻿ \t\r\xa0​")]
    single = [" ".join(raw[n].split()) for n in at]
    lines = [s.strip(" ﻿​") for s in single]
    bullet = [_BULLET.match(s) for s in lines]
    bares = [s[b.end() :] if b else s for s, b in zip(lines, bullet, strict=True)]
    lows = [s.casefold().rstrip(":") for s in bares]
    n = len(lines)
    kind = [""] * n
    is_menu = [False] * n
    for i, s in enumerate(lines):
        bare, low = bares[i], lows[i]
        if (s[0] in "%$<[{#-*@xXtTfFuUnNlL" or not s[0].isalnum()) and _MARKER.match(s):
            kind[i] = "marker"
        elif low in MENU:
            is_menu[i] = True
        elif low in _BOX:
            kind[i] = "title"
        elif cued(bare):
            kind[i] = "notice"
        else:
            wide = raw[at[i]].strip()
            # without a bar and with single spaces only, the line is one part
            parts = [p for p in _COLUMNS.split(wide.replace("\r", "").strip()) if p] if "|" in wide or len(wide) != len(single[i]) or "\r" in wide else ()
            if len(parts) >= 2 and sum(_BULLET.sub("", p).casefold() in MENU for p in parts) >= 0.6 * len(parts):
                kind[i] = "menu"
            elif _CRUMB_MARK.search(s) and _CRUMB.match(s) and not re.search(r"\d", s):
                kind[i] = "crumb"

    # the line of the page's person
    def mine(i: int) -> bool:
        if kind[i] or is_menu[i] or not _looks_name(lines[i]):
            return False
        found = name_words(lines[i])
        return bool(found) and any(alike(a, b) for a in found for b in own if len(a) > 3 or a == b) and (not own or any(alike(a, own_last) for a in found for own_last in own[-3:]))

    longest = max(own, key=len, default="")
    name_at = next((i for i in range(n) if mine(i) and any(alike(w, longest) or alike(w, own[-1]) or alike(w, own[0]) for w in name_words(lines[i]))), None)
    if name_at is None:
        name_at = next((i for i in range(1, n) if not kind[i - 1] and not is_menu[i - 1] and _looks_name(lines[i - 1]) and has_position(lines[i]) and not kind[i]), None)
        name_at = None if name_at is None else name_at - 1
    if name_at is None:
        name_at = next((i for i in range(n) if not kind[i] and not is_menu[i] and at[i] not in recurrent and (len(lines[i]) > 90 and not _TEASER.match(lines[i]) or has_position(lines[i]))), n)
        while name_at > 0 and name_at < n and not kind[name_at - 1] and lines[name_at - 1].startswith("#"):
            name_at -= 1

    if recurrent:
        _mark_recurrent(kind, lines, bullet, [not is_menu[i] and i != name_at and at[i] in recurrent for i in range(n)], name_at)

    # boxes: a title implies a block of the entries that fit it
    i = 0
    while i < n:
        if kind[i] != "title":
            i += 1
            continue
        what = _BOX[lows[i]]
        j = i + 1
        while j < n and j != name_at and kind[j] in ("", "notice") and _entry(what, lines[j], kind[j], is_menu[j], own):
            kind[j], j = "box", j + 1
        ambiguous = lows[i] in MENU
        kind[i] = "box" if j > i + 1 or not ambiguous else "notice"
        i = j

    # menus: entries in runs, or outside the body
    i = 0
    while i < n:
        if not is_menu[i]:
            i += 1
            continue
        j = i
        while j < n and is_menu[j]:
            j += 1
        if j - i >= 2 or i < name_at or bullet[i]:
            for k in range(i, j):
                kind[k] = "menu"
            # a run in the body may end with the heading of what follows
            last = j - 1
            if i > name_at and j < n and not kind[j] and (len(lines[j]) > 60 or bullet[j]) and not bullet[last] and i - 1 >= 0 and j - i <= 2:
                kind[last] = ""
        i = j
    for i, s in enumerate(lines):
        if i < name_at and kind[i] in ("", "title"):
            kind[i] = "head"
        if kind[i] == "" and len(s) < 160 and ("," in s or "|" in s) and _ADDRESS_FOOT.match(s) and _INSTITUTION.search(s[:80]) and not _PUBLISHED.search(s):
            kind[i] = "footer"

    # what follows the last line of substance is the footer
    last = max((i for i in range(n) if kind[i] == "" and not is_menu[i]), default=-1)
    for i in range(n):
        if i > last and kind[i] == "":
            kind[i] = "footer"
    # short lines between notices continue them
    for i in range(1, n - 1):
        if kind[i] == "" and i > name_at and kind[i - 1] == "notice" and kind[i + 1] in ("notice", "menu", "footer") and len(lines[i]) < 24 and not _looks_heading(lines[i]) and not re.search(r"\d", lines[i]):
            kind[i] = "notice"
    return [(at[i], kind[i] or ("name" if i == name_at else "main")) for i in range(n)]


def _mark_recurrent(kind: list[str], lines: list[str], bullet: list[re.Match | None], recurs: list[bool], name_at: int) -> None:
    """Lines that recur are notices, but for headings, position and contact lines right under the name, and entries of lists that don't recur as a whole."""
    n = len(lines)
    under = name_at + 1
    while under < n and not kind[under] and len(lines[under]) < 100 and (under == name_at + 1 or not recurs[under] or has_position(lines[under]) or re.search(r"@|\d", lines[under])):
        under += 1
    i = 0
    while i < n:
        if not bullet[i]:
            if recurs[i] and not kind[i] and not name_at < i < under and not (len(lines[i].split()) <= 5 and _looks_heading(lines[i])):
                kind[i] = "notice"
            i += 1
            continue
        j = i
        while j < n and bullet[j]:
            j += 1
        if sum(recurs[i:j]) > 0.5 * (j - i):
            for k in range(i, j):
                kind[k] = kind[k] or ("notice" if recurs[k] else "")
        i = j


def _entry(what: str, s: str, kind: str, in_menu: bool, own: list[str]) -> bool:
    """Whether a line may be an entry of a box of that kind."""
    mark = _BULLET.match(s)
    bare = s[mark.end() :] if mark else s
    if s.startswith("#"):
        return False
    if what == "links":
        return len(bare.split()) <= 4 and not re.search(r"\d|[.,]$", bare) and not has_position(bare)
    if what == "people":
        return _looks_name(s) and not in_menu
    if what == "news":
        return bool(_TEASER.match(s) or _MORE.search(s) or (len(s) < 100 and _CALL.match(s) and not s.endswith("."))) and not has_position(bare[:40])
    if what == "contact":
        return len(s) < 80 and bool(re.search(r"@|\bat\b|\d{3}", s)) and not any(w in own for w in name_words(s) if len(w) > 3)
    short = len(s) < 100 and not re.search(r"[.:]$", s) and not _BULLET.match(s) and not _looks_heading(s) and not _YEARS.search(s) and not has_position(s)
    return short or kind == "notice" and cued(bare)


def _looks_heading(s: str) -> bool:
    return s.startswith("#") or s.endswith(":") or s.isupper() or (s[:1].isupper() and len(s.split()) <= 3)


# ---------------------------------------------------------------- a tree of lines

#: The element that each kind of line stands in; what is hidden is so by its element.
_REGION = {"menu": "nav", "crumb": "nav", "box": "aside", "footer": "footer", "notice": "notice", "marker": "notice", "head": "banner"}
_ROW = re.compile(r"\t+|\s\|\s|(?<=\S) {2,}(?=\S)")


def line_tree(text: str, own: list[str] | None = None, recurrent: frozenset[int] | set[int] = _NO_RECURRENCE, kinds: list[tuple[int, str]] | None = None) -> Node:
    """The element tree that the lines of a text without markup imply.

    Each line starts an element and thereby ends those that can't hold it: a menu entry
    opens a ``nav``, a box title an ``aside``, the person's line the ``article``; in it a
    heading ends lists, tables and paragraphs, a bullet opens a list (a deeper one a list
    within), lines of equally many cells a table, a blank line ends a paragraph.
    Leaves know their line numbers, so the tree tells both what is visible and which
    lines aren't.
    """
    raw = [s.replace("\r", "") for s in text.split("\n")]
    root = Node("body", {})
    kinds = elements(text, own, recurrent) if kinds is None else kinds
    cells = {n: _ROW.split(raw[n].strip()) for n, k in kinds if k == "main" and ("|" in raw[n] or "\t" in raw[n] or "  " in raw[n])}
    region: Node | None = None
    lists: list[tuple[int, Node]] = []
    block: Node | None = None
    before = -1

    def leaf(parent: Node, tag: str, n: int, content: str) -> Node:
        node = Node(tag, {"lines": [n]})
        node.children.append(content)
        parent.children.append(node)
        return node

    for i, (n, kind) in enumerate(kinds):
        tag = _REGION.get(kind, "article")
        if region is None or region.tag != tag:
            region = Node(tag, {"hidden": "", "lines": []} if kind in HIDDEN_KINDS else {})
            root.children.append(region)
            lists, block = [], None
        if n > before + 1:
            block = None
        before = n
        if tag != "article":
            region.attrs["lines"].append(n)
            region.children += [raw[n], Node("br", {})]
            continue
        s = raw[n].strip("﻿ \t\xa0​")
        mark = _BULLET.match(raw[n])
        if kind == "name" or s.startswith("#") or (s.endswith(":") and len(s.split()) <= 6):
            lists, block = [], None
            leaf(region, "h1" if kind == "name" else "h2", n, s)
        elif mark:
            deep = len(raw[n]) - len(raw[n].lstrip())
            while lists and lists[-1][0] > deep:
                lists.pop()
            if not lists or lists[-1][0] < deep:
                ul = Node("ul", {})
                (lists[-1][1].children[-1] if lists else region).children.append(ul)
                lists.append((deep, ul))
            block = None
            leaf(lists[-1][1], "li", n, _BULLET.sub("", s))
        else:
            lists = []
            width = len(cells[n]) if n in cells else 1
            near = [m for m, k in (kinds[i - 1] if i else (-9, ""), kinds[i + 1] if i + 1 < len(kinds) else (-9, "")) if k == "main" and abs(m - n) == 1 and not _BULLET.match(raw[m])] if width > 1 else []
            if any(len(cells[m]) == width for m in near if m in cells):
                if block is None or block.tag != "table" or block.attrs["width"] != str(width):
                    block = Node("table", {"width": str(width)})
                    region.children.append(block)
                row = Node("tr", {"lines": [n]})
                for c in cells[n]:
                    cell = Node("td", {})
                    cell.children.append(c)
                    row.children.append(cell)
                block.children.append(row)
            else:
                if block is None or block.tag != "p":
                    block = Node("p", {"lines": []})
                    region.children.append(block)
                if block.children:
                    block.children.append(Node("br", {}))
                block.children.append(s)
                block.attrs["lines"].append(n)
    return root


def parted(kinds: list[tuple[int, str]]) -> tuple[list[int], list[int]]:
    """What :func:`lines_of` tells of the tree of such lines: each stands in one element, which its kind names, and what is within an article is visible."""
    return [n for n, k in kinds if k not in HIDDEN_KINDS], [n for n, k in kinds if k in HIDDEN_KINDS]


def lines_of(node: Node, hidden: bool = False) -> tuple[list[int], list[int]]:
    """Numbers of the visible lines under an element, and of the others."""
    kept: list[int] = []
    other: list[int] = []
    work = [(node, hidden)]
    while work:
        e, out = work.pop()
        out = out or not e.visible()
        (other if out else kept).extend(e.attrs.get("lines", ()))
        work.extend((c, out) for c in e.children if isinstance(c, Node) and c.tag != "br")
    return sorted(kept), sorted(other)


def main_lines(text: str, own: list[str] | None = None, recurrent: frozenset[int] | set[int] = _NO_RECURRENCE) -> tuple[list[int], list[int]]:
    """Numbers of the lines of the main text, and of the other lines that aren't blank."""
    return lines_of(line_tree(text, own, recurrent))


def tidy(text: str) -> str:
    """Rendered text with at most one blank line between blocks and no stray blanks; list and table indents stay."""
    lines = [s.rstrip() if s.startswith(" ") and s.lstrip().startswith(("- ", "1")) else s.strip() if "  " not in s.strip() else s.rstrip() for s in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n ")


def render_lines(root: Node) -> str:
    """The visible text of a tree of lines, with blocks apart, lists and aligned cells."""
    return tidy("".join(_text(c) for c in root.children if isinstance(c, Node) and c.visible()))
