"""Clean text from texts with HTML, Markdown, wiki or LaTeX residue (problem 5).

The grammars are one list of rules (:data:`RULES`): each recognises a whole construct, not a sign, and says what it turns
into. Ordinary signs are no constructs: ``- `` before list lines, comparison signs, money, bracketed numbers, note marks
such as ``(\\*)``, products, set braces and file names stay as they are. Rules are applied from the outside in until
nothing changes, so constructs inside constructs are converted however deep they lie. What is literal, such as the signs
in code, is masked from then on, and character references are resolved once, last of all: what they give is text and is
never read as markup again.

Structure is kept recognisable by marks: the kind and place, in the clean text, of headings, lists, tables, code and
formulas. Headings stand on lines of their own, list items begin with ``- ``, cells are parted by `` | ``, code is kept as
written, formulas become linear text, notes stand in parentheses.

The method named for this problem, differencing pages of near addresses, deletes lines that pages of one host share. It was
measured (README): few items have a neighbour of their host, and shared lines are not where the markup is, so it cannot
give the required result; this module parses the markup instead.

Defined results: null and empty texts and texts without markup are left out by :func:`converted`; unbalanced signs are
kept; the 32 noncharacters from U+FDD0, which no text may use, are dropped. Repeated rows stay repeated.
"""

from __future__ import annotations

import html
import html.entities
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Noncharacters that stand for the beginning of a marked place, by kind, and for its end.
KINDS = ("heading", "list", "table", "code", "formula", "quote", "link")
_OPEN = {k: chr(0xFDD0 + i) for i, k in enumerate(KINDS)}
_CLOSE = chr(0xFDDF)
_MARKS = regex.compile("[\ufdd0-\ufdd6\ufddf]")
_RESERVED = regex.compile("[\ufdd0-\ufdef]")
# Signs that are literal from the rule on that said so, and the noncharacters that stand for them until the end.
_SIGNS = "<>&*_`~[]{}\\$=|#'!-+()"
_MASK = dict(zip(map(ord, _SIGNS), (*range(0xFDD7, 0xFDDF), *range(0xFDE0, 0xFDF0)), strict=False))
_UNMASK = {v: k for k, v in _MASK.items()}

_LATE_OPEN = regex.compile("([\ufdd0-\ufdd6]+)(\\s+)")
_EARLY_CLOSE = regex.compile("(\\s+)(\ufddf+)")

# Elements of HTML and of wikis, in alphabetical order.
TAGS = """a abbr acronym address applet area article aside audio b base basefont bdi bdo big blockquote body br button canvas caption
center cite code col colgroup data datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer
form frame frameset gallery h1 h2 h3 h4 h5 h6 head header hgroup hr html i iframe img includeonly input ins kbd label legend li link
main map mark math menu meta meter nav noframes noinclude noscript nowiki object ol onlyinclude optgroup option output p param
picture poem pre progress q ref references rp rt ruby s samp section select slot small source span strike strong style sub summary
sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr""".split()  # fmt: skip
# Attributes without a value.
_FLAGS = "allowfullscreen|async|autofocus|autoplay|checked|compact|controls|default|defer|disabled|hidden|ismap|loop|multiple|muted|noshade|novalidate|nowrap|open|readonly|required|reversed|selected"

# Signs of formulas, by their LaTeX names.
SIGNS = {
    "le": "≤", "leq": "≤", "ge": "≥", "geq": "≥", "ne": "≠", "neq": "≠", "times": "×", "cdot": "·", "pm": "±", "infty": "∞",
    "sum": "∑", "prod": "∏", "int": "∫", "approx": "≈", "in": "∈", "to": "→", "alpha": "α", "beta": "β", "gamma": "γ",
    "delta": "δ", "lambda": "λ", "mu": "μ", "pi": "π", "sigma": "σ", "quad": " ", "ldots": "…", "dots": "…",
}

_LINE = r"(?:(?<=\A|[\n\r])|(?<=\A- |[\n\r]- ))"
_ATTRIBUTES = rf"(?:(?:\s+(?:[A-Za-z_:@][\w:.-]*\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'|[^\s\"'<>=`]+)|(?:{_FLAGS})\b))*|\s[^<>]*\w=[^\s<>][^<>]*)\s*"
_TAG = rf"(?:{'|'.join(TAGS)})"
_BRACES = r"\{((?:[^{}\n]|\n(?!\n)|\{(?:[^{}\n]|\{[^{}\n]*\})*\})*)\}"


def _mask(text: str) -> str:
    return text.translate(_MASK)


def _code(text: str) -> str:
    return _mark("code", _mask(text))


def _html_code(m: regex.Match) -> str:
    return _code(html.unescape(regex.sub(r"(?i)</?[a-z][a-z0-9]*\b[^<>]*>", "", m["inside"])))


def _reference(m: regex.Match) -> str:
    """A link by reference, if the text defines the name."""
    name = m[2] or m[1]
    return _mark("link", m[1]) if regex.search(rf"(?mi)^ ?\[{regex.escape(name)}\]:[ \t]+\S", m.string) else m[0]


def _paired(m: regex.Match) -> str:
    return m["inside"]


def _mark(kind: str, text: str) -> str:
    return f"{_OPEN[kind]}{text}{_CLOSE}"


def _own_line(kind: str, text: str) -> str:
    return f"\n{_mark(kind, text.strip())}\n"


def formula(tex: str) -> str:
    """Linear text of a LaTeX formula."""
    out = tex.strip()
    for _ in range(len(out)):  # every round that changes something removes signs
        new = regex.sub(r"\\[dt]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1)/(\2)", out)
        new = regex.sub(r"\\sqrt\s*\{([^{}]*)\}", r"√(\1)", new)
        new = regex.sub(r"\\(?:text|mathrm|mathbf|mathit|operatorname)\s*\{([^{}]*)\}", r"\1", new)
        new = regex.sub(r"([_^])\{(\w+)\}", r"\1\2", new)
        new = regex.sub(r"([_^])\{([^{}]*)\}", r"\1(\2)", new)
        if new == out:
            break
        out = new
    return regex.sub(r"\\([a-zA-Z]+)", lambda m: SIGNS.get(m[1], m[1]), out).replace("\\,", " ")


def _entity(m: regex.Match) -> str:
    return html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html.entities.html5 else m[0]


def _tag(m: regex.Match) -> str:
    name, closing = m["tag"].lower(), m[0][1] == "/"
    if name in ("br", "hr"):
        return "\n"
    if name in ("h1", "h2", "h3", "h4", "h5", "h6", "title"):
        return _CLOSE + "\n" if closing else "\n" + _OPEN["heading"]
    if name == "math":
        return _CLOSE if closing else _OPEN["formula"]
    if name in ("ul", "ol", "dl"):
        return "\n" + _CLOSE if closing else _OPEN["list"] + "\n"
    if name == "table":
        return "\n" + _CLOSE if closing else _OPEN["table"] + "\n"
    if name in ("li", "dt", "dd"):
        return "" if closing else "\n- "
    if name in ("td", "th"):
        return " | " if closing else ""
    if name in ("p", "div", "tr", "section", "article", "blockquote", "body", "html", "head", "caption", "figure", "address", "details", "summary"):
        return "\n"
    return ""


def _pipes(m: regex.Match) -> str:
    rows = [r.strip() for r in m[0].strip().splitlines()]
    cells = [[c.strip() for c in r.strip("|").split("|")] for r in rows]
    kept = [" | ".join(r) for r in cells if not all(regex.fullmatch(r":?-{2,}:?", c) for c in r)]
    return "\n" + _mark("table", "\n".join(kept)) + "\n"


def _wiki_link(m: regex.Match) -> str:
    target, _, label = m[1].rpartition("|")
    if not target and regex.match(r"(?i)(?:category|file|image)\s*:", m[1]):
        return ""
    return _mark("link", label)


def _template(m: regex.Match) -> str:
    parts = [p for p in m[1].split("|")[1:] if "=" not in p]
    return " " + " ".join(parts) if parts else ""


def _items(m: regex.Match) -> str:
    return "\n" + _mark("list", regex.sub(r"\\item\b(?:\[[^\]\n]*\])?[ \t]*", "- ", m[2]).strip()) + "\n"


Rule = tuple[str, str, Callable[[regex.Match], str]]

#: (name, pattern, conversion); a name's first part is the language of the markup.
RULES: list[Rule] = [
    ("html_comment", r"<!--.*?-->", lambda m: ""),
    ("html_declaration", r"(?i)<!doctype\b[^<>]*>|<\?(?:xml|php)\b.*?\?>", lambda m: ""),
    ("html_cdata", r"<!\[CDATA\[(.*?)\]\]>", lambda m: _mask(m[1])),
    ("html_script", r"(?i)<(script|style)\b[^<>]*>.*?</\1\s*>", lambda m: ""),
    ("markdown_fence", _LINE + r"(```|~~~)[^\n`~]*\n(.*?)\n?\1", lambda m: "\n" + _code(m[2]) + "\n"),
    ("wiki_nowiki", r"(?i)<nowiki>(.*?)</nowiki>", lambda m: _code(m[1])),
    ("markdown_code", r"(?<!`)(`{1,2})(?=[^`\s])([^`\n]*[^`\s])\1(?!`)", lambda m: _code(m[2])),
    ("html_code", rf"(?i)<(?P<tag>pre|code|tt|kbd|samp|listing|xmp){_ATTRIBUTES}>(?P<inside>.*?)</(?P=tag)\s*>", _html_code),
    ("latex_verbatim", r"\\begin\{(verbatim|lstlisting)\*?\}(?:\[[^\]\n]*\])?\n?(.*?)\n?\\end\{\1\*?\}", lambda m: "\n" + _code(m[2]) + "\n"),
    ("latex_verb", r"\\verb\*?([|!+/@])(.+?)\1", lambda m: _code(m[2])),
    ("latex_list", r"\\begin\{(itemize|enumerate|description)\}(.*?)\\end\{\1\}", _items),
    ("latex_display", r"\\\[(.+?)\\\]", lambda m: _mark("formula", formula(m[1]))),
    ("latex_equation", r"\\begin\{(equation|align|displaymath|math|gather)\*?\}(.*?)\\end\{\1\*?\}", lambda m: _mark("formula", formula(m[2]))),
    ("latex_inline", r"\\\((.+?)\\\)", lambda m: _mark("formula", formula(m[1]))),
    ("latex_double", r"\$\$(?=\S)([^$]+?)(?<=\S)\$\$", lambda m: _mark("formula", formula(m[1]))),
    ("latex_dollar", r"(?<![\\$\w])\$(?=[^\s$])((?:[^$\n]*?[\\_^{}=][^$\n]*?|[A-Za-z]))(?<=[^\s\\])\$(?![\d$])", lambda m: _mark("formula", formula(m[1]))),
    ("latex_section", r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\{([^{}\n]*)\}", lambda m: _own_line("heading", m[1])),
    ("latex_name", r"(?<![\w\\:])\\(?:La)?TeX\b(?:\{\})?", lambda m: m[0].strip("\\{}")),
    ("latex_cite", r"~?\\(?:cite[a-z]*|ref|eqref|label|pageref|index)\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}", lambda m: ""),
    ("latex_note", r"\\footnote(?:mark|text)?" + _BRACES, lambda m: f" ({m[1]})"),
    ("latex_environment", r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?", lambda m: "\n"),
    ("latex_switch", r"\{\\(?:em|bf|it|sl|sc|tt|rm|sf|large|small|itshape|bfseries|scshape|ttfamily)\b[ \t]*([^{}]*)\}", lambda m: m[1]),
    ("latex_command", r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?" + _BRACES, lambda m: m[1]),
    ("latex_item", r"\\item\b[ \t]*", lambda m: "- "),
    ("wiki_template", r"\{\{([^{}]+)\}\}", _template),
    ("wiki_link", r"\[\[([^\[\]\n]+)\]\]", _wiki_link),
    ("wiki_external", r"\[(?:https?|ftp)://[^\s\[\]]+(?:[ \t]+([^\[\]\n]+))?\]", lambda m: _mark("link", m[1]) if m[1] else ""),
    ("wiki_table", _LINE + r"\{\|.*?\n\|\}", lambda m: "\n" + _mark("table", "\n".join(regex.sub(r"\s*(?:\|\||!!)\s*", " | ", r.lstrip("|! ")) for r in m[0].splitlines()[1:-1] if not regex.match(r"\|[-+]", r))) + "\n"),
    ("wiki_heading", _LINE + r"(={2,6})[ \t]*([^=\n\r](?:[^\n\r]*?[^=\n\r])?)[ \t]*\1[ \t]*(?=[\n\r]|\Z)", lambda m: _own_line("heading", m[2])),
    ("wiki_emphasis", r"('{2,5})(?=[^\s'])([^\n]*?[^\s'])\1(?!')", lambda m: m[2]),
    ("html_reference", r"(?i)<ref\b[^<>]*?/\s*>|<ref\b[^<>]*>(.*?)</ref\s*>", lambda m: f" ({m[1].strip()})" if (m[1] or "").strip() else ""),
    ("html_link", r"<((?:https?|ftp)://[^\s<>]+|mailto:[^\s<>]+|[\w.+-]+@[\w-]+(?:\.[\w-]+)+)>", lambda m: m[1]),
    ("html_tag", rf"(?i)</?(?P<tag>{_TAG})(?:{_ATTRIBUTES}|\s*)/?\s*>", _tag),
    ("html_namespaced", rf"</?[A-Za-z][\w-]*:[A-Za-z][\w.-]*{_ATTRIBUTES}/?>", lambda m: ""),
    ("html_other", rf"<(?P<tag>[A-Za-z][\w-]*){_ATTRIBUTES}>(?P<inside>[^<>]*)</(?P=tag)\s*>", _paired),
    ("markdown_table", r"(?:(?<=\A|[\n\r]))(?:[ \t]*\|(?=[^\n\r]*[^\s|])[^\n\r]*\|[ \t]*(?:\r?\n|\Z)){1,}", _pipes),
    ("markdown_heading", _LINE + r" {0,3}#{1,6}[ \t]+([^\n\r]*[^\s#])[ \t]*#*(?=[\n\r]|\Z)", lambda m: _own_line("heading", m[1])),
    ("markdown_setext", _LINE + r"(?![|>]|- )([^\n\r]++)(?<=\w[^\n\r]*)\r?\n(?:={3,}|-{3,})[ \t]*(?=[\n\r]|\Z)", lambda m: _own_line("heading", m[1])),
    ("markdown_bullets", r"(?:(?<=\A|[\n\r])[*+][ \t]+\S[^\n\r]*(?:\r?\n|\Z)){2,}", lambda m: "\n" + _mark("list", regex.sub(r"(?m)^[*+][ \t]+", "- ", m[0].strip())) + "\n"),
    ("markdown_note", _LINE + r"\[\^[^\[\]\s]+\]:[ \t]+([^\n\r]*)", lambda m: f"({m[1]})"),
    ("markdown_note_mark", r"\[\^[^\[\]\s]+\]", lambda m: ""),
    ("markdown_reference", r"(?<!\])\[([^\[\]\n]+)\] ?\[([^\[\]\n]*)\]", _reference),
    ("markdown_definition", r"(?:(?<=\A|[\n\r])) {0,3}\[[^\[\]\n^][^\[\]\n]*\]:[ \t]+<?(?:[a-z]+://|/|#|\w[\w.-]*/)\S*[^\n\r]*(?:\r?\n|\Z)", lambda m: ""),
    ("markdown_image", r"!?\[([^\[\]\n]*)\]\((?:[^()\s]*[/.:#][^()\s]*)(?:\s+\"[^\"\n]*\")?\)", lambda m: _mark("link", m[1])),
    ("markdown_strong", r"(?<![\\*])(?<!\w(?=\*+\d))\*{2,3}(?=[^\s*])([^*]*?[^\s*\\])\*{2,3}(?!\*)", lambda m: m[1]),
    ("markdown_underscores", r"(?<![\w\\])_{2,3}(?=[^\s_])((?:[^_]|(?<=\w)_(?=\w))*?[^\s_])_{2,3}(?!\w)", lambda m: m[1]),
    ("markdown_strike", r"(?<!~)~~(?=[^\s~])([^~]*?[^\s~])~~(?!~)", lambda m: m[1]),
    ("markdown_emphasis", r"(?<![\\*\w])\*(?=[\w«“\"'(])((?:[^*\n]|\n(?!\n))*?[\w.,;:!?)»”\"'])\*(?![*\w])", lambda m: m[1]),
    ("markdown_underscore", r"(?<![\\_\w])_(?=[^\W_])([^_\n]*?[\w.,;:!?)])_(?!\w|\.\w)", lambda m: m[1]),
    ("markdown_quote", _LINE + r"> ?(?=[\p{L}«“\"(*_])", lambda m: ""),
]
_ENTITY = regex.compile(r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});")
_COMPILED = [(name, regex.compile(pattern, regex.DOTALL), to) for name, pattern, to in RULES]

#: In Java's grammar, what every text with a construct holds: the cheap test before the rules.
SUSPECT = r"<[A-Za-z/!?]|&[#A-Za-z]|(?m)^(?:- )?(?:[ ]{0,3}#|>|==|---|[+] |[ \t]*\||\{\||[ ]{0,3}\[)|[*_`]|~~|\]\(|\[\[|\[\^|\[\w+://|\{\{|''|\\[A-Za-z(\[]|\$"


def convert(text: str) -> tuple[str, list[tuple[str, int, int]], list[str]]:
    """(clean text, marks (kind, begin, end), names of the rules that applied, each once)."""
    applied: dict[str, None] = {}
    work = _RESERVED.sub("", text)
    for _ in range(len(work)):  # until nothing changes; a conversion removes signs, so the length is never reached
        before = work
        for name, pattern, to in _COMPILED:
            new = pattern.sub(to, work)
            if new != work:
                applied[name] = None
                work = new
        if work == before:
            break
    if (new := _ENTITY.sub(_entity, work)) != work:
        applied["html_entity"] = None
        work = new
    if not applied:
        return text, [], []
    work = work.translate(_UNMASK)
    work = _LATE_OPEN.sub(r"\2\1", _EARLY_CLOSE.sub(r"\2\1", work))  # marked places begin and end with what is shown
    work = regex.sub(r"[ \t]*\n[ \t]*(?:\n[ \t]*)+", "\n\n", work).strip()
    marks, stack, parts, size, at = [], [], [], 0, 0
    for m in _MARKS.finditer(work):
        parts.append(work[at : m.start()])
        size += m.start() - at
        at = m.end()
        if m[0] != _CLOSE:
            stack.append((KINDS[ord(m[0]) - 0xFDD0], size))
        elif stack:
            kind, begin = stack.pop()
            if size > begin:
                marks.append((kind, begin, size))
    parts.append(work[at:])
    return "".join(parts), sorted(marks, key=lambda x: (x[1], -x[2])), list(applied)


def suspect(text: Column) -> Column:
    """Whether a text may hold markup; false only where it holds none."""
    return text.rlike(SUSPECT)


def converted(items: DataFrame) -> DataFrame:
    """(item_kind, item_id, clean, marks, rules) of the items (item_kind, item_id, text) that hold markup."""
    mark = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])
    types = (pa.string(), pa.string(), pa.string(), pa.list_(mark), pa.list_(pa.string()))
    names = ["item_kind", "item_id", "clean", "marks", "rules"]
    ddl = "item_kind string, item_id string, clean string, marks array<struct<kind:string,begin:int,end:int>>, rules array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kind, item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                clean, marks, applied = convert(text)
                if applied:
                    rows.append((kind, item, clean, [dict(zip(("kind", "begin", "end"), m, strict=True)) for m in marks], applied))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return items.select("item_kind", "item_id", "text").where(suspect(F.col("text"))).mapInArrow(run, ddl)
