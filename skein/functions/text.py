"""Text functions as Columns: normalising, paragraphs, sentences, tokens, similarity of token sets."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

#: Regex flags that read classes, case and lines as Unicode text does; white space with the separators U+001C to U+001F.
FLAGS, FLAGS_I, SPACE = "(?dU)", "(?dUi)", "[\\s\\x1c-\\x1f]"


#: The characters of SPACE.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def words(alternation: str) -> str:
    return f"{FLAGS_I}\\b(?:{alternation})\\b"


def tree(alternation: str) -> str:
    """An alternation that accepts the same whole words by a tree of their beginnings, so that a word is tried once."""
    root: dict = {}
    for item in re.findall(r"(?:\(\?:[^)]*\)|[^|(])+", alternation):
        at = root
        for atom in re.findall(r"(?:\(\?:[^)]*\)|\\.|.)(?:\{[^}]*\}|\?)?", item):
            at = at.setdefault(atom, {})
        at[""] = {}

    def written(node: dict) -> str:
        more = [atom + written(rest) for atom, rest in node.items() if atom]
        if len(more) == 1 and "" not in node:
            return more[0]
        return f"(?:{'|'.join(more)})" + ("?" if "" in node else "") if more else ""

    return written(root)


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def _held(x: Column, sign: str, value: Column, else_: Column | int | bool) -> Column:
    """value where x holds the sign, without which it would be else_; spares a search by pattern."""
    return F.when(F.contains(x, F.lit(sign)), value).otherwise(else_)


def _once(x: Column, change: Callable[[Column], Column]) -> Column:
    """change(x), with x computed once however often change names it."""
    return F.transform(F.array(x), change)[0]


def normalised(text: Column) -> Column:
    """Newlines as LF, blanks at line ends gone, at most one empty line in a row."""
    x = F.coalesce(_held(text, "\r", F.regexp_replace(text, "\\r\\n?", "\n"), text), F.lit(""))
    for blank in "\t\x0b\x0c":
        x = F.replace(x, F.lit(blank), F.lit(" "))
    x = _once(x, lambda t: _held(t, " \n", trimmed := F.regexp_replace(t, " *\\n *", "\n"), _held(t, "\n ", trimmed, t)))
    return strip(_once(x, lambda t: _held(t, "\n\n\n", F.regexp_replace(t, "\\n{3,}", "\n\n"), t)))


def paragraphs(text: Column) -> Column:
    """Array of blocks between blank lines."""
    return F.filter(F.transform(F.split(text, f"{FLAGS}\\n\\s*\\n"), strip), lambda b: b != "")


#: Regex pieces of title case: a run of capitals and letters, and all else.
_TITLE = "\\A[^C]*[\\p{Lu}\\p{Lt}]\\p{Ll}*(?:[^C]+[\\p{Lu}\\p{Lt}]\\p{Ll}*)*[^C]*\\z".replace("C", "\\p{Lu}\\p{Ll}\\p{Lt}")


def is_heading(block: Column) -> Column:
    line = F.substring_index(block, "\n", 1)
    letters = F.length(F.regexp_replace(line, "\\P{L}", ""))
    upper = line.rlike("\\p{Lu}") & ~line.rlike("[\\p{Ll}\\p{Lt}]")
    short = (F.length(line) <= 80) & ~F.contains(block, F.lit("\n")) & ~line.rlike("(?d)[.!?]$") & (letters >= 3)
    return line.rlike(f"{FLAGS}^#{{1,6}}\\s+.+$") | line.rlike(f"{FLAGS}^\\[Page \\d+\\]$") | (short & (upper | line.rlike(_TITLE)))


_ABBREVIATED = "|".join(re.escape(a) for a in sorted(L.ABBREVIATIONS, key=len, reverse=True))
_BOUNDARY = f"{FLAGS}([.!?])(?<!(?<![\\w.])(?:{_ABBREVIATED}|\\d{{1,2}}|[A-Z])\\.)({L.CITATION})?\\s+(?=[\"'“‘(]*[A-Z0-9])"


def sentences(paragraph: Column) -> Column:
    """Array of sentences. A citation stays with the sentence that it follows; periods of abbreviations, initials and
    ordinals don't end one."""
    marked = F.regexp_replace(paragraph, _BOUNDARY, "$1$2\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), strip), lambda s: s != "")


def tokens(text: Column) -> Column:
    """Array of lower-case content tokens, in order, repeats kept."""
    return _content(_words_of(text))


def _words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9']+"), F.lit(0))


def _content(found: Column) -> Column:
    return F.filter(found, lambda t: (F.length(t) > 2) & ~t.isin(*L.STOP_WORDS))


def token_set(text: Column) -> Column:
    return _content(F.array_distinct(_words_of(text)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 if either is empty."""
    empty = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(empty, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def needs_refining(text: Column) -> Column:
    """A fragment: begins in lower case, has under five words, or begins with a dangling word."""
    first = F.regexp_replace(F.lower(F.regexp_extract(text, f"{FLAGS}^{SPACE}*([^\\s\\x1c-\\x1f]+)", 1)), "[,.;:]+\\z", "")
    count = F.size(F.filter(F.split(text, f"{FLAGS}{SPACE}+"), lambda w: w != ""))
    return (strip(text) != "") & (strip(text).rlike("^\\p{Ll}") | (count < 5) | first.isin(*L.DANGLING_HEADS))


def genre(text: Column) -> Column:
    """fiction, nonfiction, mixed or unknown, by counts of cues."""
    low = F.lower(text)
    count = lambda x, p: F.regexp_count(x, F.lit(p))
    fiction = count(low, f"{FLAGS}\\b{tree(L.FICTION_CUES)}\\b")
    structure = 2 * _held(text, "#", count(text, f"(?m){FLAGS}^#{{1,6}}\\s+\\S"), 0) + _held(text, "[", count(text, L.CITATION), 0)
    signal = count(low, f"{FLAGS}\\b{tree(L.NONFICTION_CUES)}\\b") + structure
    blocks = F.filter(F.split(low, f"{FLAGS}\\n\\s*\\n"), lambda p: strip(p) != "")
    spoken = F.size(F.filter(blocks, lambda p: (F.regexp_count(p, F.lit('["“”]')) >= 2) & p.rlike(f"{FLAGS}\\b(?:{L.SPEECH_VERBS})\\b")))
    spoken = F.when(text.rlike('["“”]'), spoken).otherwise(0)
    dashes = F.when(text.rlike("[—–]"), count(text, f"{FLAGS}(?:^|\\n)\\s*[—–]\\s+")).otherwise(0)
    told = ((spoken >= 2) & (spoken / F.greatest(F.lit(1), F.size(blocks)) >= 0.3)) | (dashes >= 4)
    return (
        F.when((structure >= 3) & ~told & (fiction < 3), "nonfiction")
        .when(told & (fiction >= signal), "fiction")
        .when((fiction >= 3) & (signal == 0), "fiction")
        .when(signal >= F.greatest(F.lit(3), fiction + 2), "nonfiction")
        .when((fiction > 0) & (signal > 0), "mixed")
        .otherwise("unknown")
    )
