"""Markdown and MDX to plain text, for documents whose format is known.

Markdown is read once from left to right: at each place the first mark of a list that stands there decides what is shown,
and what a mark holds is read in the same way. MDX statements are taken out by lines and components by matching their tags;
code blocks and displayed formulas are opaque to both.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("md", "markdown", "rst", "mdx")
OPAQUE = r"```.*?```|\$\$.*?\$\$"


def _held(sign: str) -> str:
    """What a mark holds: no sign of its own, unless in code."""
    return rf"(?:`[^`\n]+`|`(?![^`\n]+`)|[^{sign}`\n])+"


#: Marks in order of precedence, with the part that is shown: as it is ("whole"), read on ("read"), or by name.
MARKS = {
    "whole_block": OPAQUE,
    "money": r"(?<![\\$])\$(?=\d[\d,.]*\s)(?P<amounts>[^$\n]+)\$(?!\$)",
    "whole_formula": r"(?<![\\$])\$[^$\n]+\$(?!\$)",
    "code": r"`(?P<code_text>[^`\n]+)`",
    "gone_row": r"^[ \t]*\|.*\|[ \t]*$\n?",
    "cited": r"[ \t]*<sup\b[^>]*>(?P<sup_text>(?s:.*?))</sup>",
    "note": r"[ \t]*\[\^(?P<note_text>[^\]\s]+)\]",
    "read_image": r"!\[(?P<image_text>[^\]]*)\]\([^)]*\)",
    "read_link": r"\[(?P<link_text>(?:!\[[^\]]*\]\([^)]*\)|`[^`\n]+`|[^\]])+)\]\([^)]*\)",
    "read_strong": rf"\*\*(?P<strong_text>{_held('*')})\*\*",
    "read_stress": rf"\*(?P<stress_text>{_held('*')})\*(?!\*)",
    "read_under2": rf"(?<![\w_])__(?P<under2_text>{_held('_')})__(?![\w_])",
    "read_under": rf"(?<![\w_])_(?P<under_text>{_held('_')})_(?![\w_])",
    "gone_comment": r"(?s:<!--.*?-->)",
    "line": r"<br\s*/?>",
    "gone_tag": r"</?[A-Za-z][^>]*>",
}
_SCANNER = re.compile("|".join(f"(?P<{name}>{'(?s:' + p + ')' if p == OPAQUE else p})" for name, p in MARKS.items()), re.M | re.I)
_HELD = {name: group for name in MARKS for group in _SCANNER.groupindex if group == f"{name.split('_')[-1]}_text"}
_ANCHOR = re.compile(r"<a\b[^>]*>\s*\[?\s*(\d+)\s*\]?\s*</a>", re.I)
_LISTED = re.compile(r"\s*\[[\d,\s]+\]\s*")


def _citation(inside: str) -> str | None:
    """The numbers of a raised citation in brackets: those of its links, or of a plain list."""
    numbers = _ANCHOR.findall(inside)
    plain = re.sub(MARKS["gone_tag"], "", inside)
    if not numbers and _LISTED.fullmatch(plain):
        numbers = re.findall(r"\d+", plain)
    return f"[{', '.join(numbers)}]" if numbers else None


def plain_markdown(text: str) -> str:
    def shown(m: re.Match) -> str:
        name = next(k for k in MARKS if m[k] is not None)
        kind = name.split("_")[0]
        if kind == "whole":
            return m[0]
        if kind == "gone":
            return ""
        if kind == "read":
            return plain_markdown(m[_HELD[name]])
        if name == "money":  # two amounts, not a formula
            return f"${plain_markdown(m['amounts'])}$"
        if name == "cited":
            found = _citation(m["sup_text"])
            return found if found is not None else m[0][: m[0].index("<")] + plain_markdown(m["sup_text"])
        return {"code": m["code_text"], "note": f"[{m['note_text']}]", "line": "\n"}[name]

    return _SCANNER.sub(shown, text)


#: Lines that import or export.
_IMPORT = re.compile(r"^\s*import\s.*?[\"'][^\"']+[\"']\s*;?\s*$")
_IMPORT_OPEN = re.compile(r"^\s*import\s+(?:type\s+)?[\w$*\s,]*\{")
_EXPORT = re.compile(r"^\s*export\s+(?:const|let|var)\s+\w")
_TAG = re.compile(r"^[ \t]*<(?P<opens>[A-Z][\w.]*)(?:\s[^>]*?)?(?P<alone>/?)>(?P<rest>[ \t]*\n?)|\n?[ \t]*</(?P<closes>[A-Z][\w.]*)\s*>[ \t]*$", re.M)


def _opaque(text: str):
    """A test whether a place lies within a code block or a displayed formula."""
    spans = [m.span() for m in re.finditer(OPAQUE, text, re.S)]
    starts = [a for a, _ in spans]
    return lambda at: (k := bisect_right(starts, at)) > 0 and at < spans[k - 1][1]


def _without_statements(text: str) -> str:
    inside, out, at, skipping = _opaque(text), [], 0, None
    for line in text.split("\n"):
        free, at = not inside(at), at + len(line) + 1
        if skipping == "import":  # up to a line that ends it, or an empty one
            skipping = None if not line.strip() or line.rstrip().endswith((";", '"', "'")) else skipping
        elif isinstance(skipping, int):  # of an export: open braces
            skipping = (skipping + line.count("{") - line.count("}")) or None
            skipping = None if skipping is not None and skipping < 0 else skipping
        elif free and _IMPORT.match(line):
            continue
        elif free and _IMPORT_OPEN.match(line):
            skipping = "import"
        elif free and _EXPORT.match(line):
            balance = line.count("{") - line.count("}")
            skipping = balance if balance > 0 else None
        else:
            out.append(line)
    return "\n".join(out)


def plain_mdx(text: str) -> str:
    """Statements go; components that stand on lines of their own are unwrapped, those without content go."""
    text = _without_statements(text)
    inside = _opaque(text)
    gone: list[tuple[int, int]] = []
    open_: list[tuple[str, tuple[int, int]]] = []
    for m in _TAG.finditer(text):
        at = m.start("opens") if m["opens"] else m.start("closes")
        if inside(at):
            continue
        if m["alone"]:
            if m["rest"].endswith("\n") or m.end() == len(text):
                gone.append((m.start(), m.end() - m["rest"].endswith("\n")))
        elif m["opens"]:
            open_.append((m["opens"], m.span()))
        elif any(name == m["closes"] for name, _ in open_):
            while (last := open_.pop())[0] != m["closes"]:
                pass  # what was never closed stays
            gone += [last[1], m.span()]
    out, at = [], 0
    for a, b in sorted(gone):
        out.append(text[at:max(a, at)])
        at = max(at, b)
    return "".join(out) + text[at:]


def ingested(text: Column, source_format: Column) -> Column:
    """Text by its format: MDX, then Markdown, then as it is."""

    @F.pandas_udf("string")
    def run(x: pd.Series, kind: pd.Series) -> pd.Series:
        def one(t: str | None, f: str | None) -> str:
            t, f = t or "", (f or "text").lower()
            t = plain_mdx(t) if f == "mdx" else t
            return plain_markdown(t) if f in FORMATS else t

        return pd.Series([one(t, f) for t, f in zip(x, kind, strict=True)])

    return run(text, source_format)
