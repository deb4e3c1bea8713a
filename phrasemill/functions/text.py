"""Scalar operators as Column expressions: cell filters, names, normalizers, categories.

All run on the JVM, but for lexicons of more than ``automaton.FEW`` phrases. White space is Python's: Unicode White_Space and U+001C..U+001F.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import automaton
from . import lexicon as L
from .lexicon import DEFAULT, Lexicon

SPACE = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def split_words(c: Column) -> Column:
    return F.filter(F.split(c, rf"(?U){SPACE}+", -1), lambda w: w != "")


def rstrip_marks(c: Column) -> Column:
    return F.regexp_replace(c, r"\?+\z", "")


def lowered(c: Column) -> Column:
    return strip(F.lower(c))


def starts_with_any(c: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])


def contains_any(c: Column, parts: tuple[str, ...]) -> Column:
    """Whether the text holds one of ``parts``: by an escaped alternation, which is tried at each place, or by an automaton where they are many."""
    parts = tuple(dict.fromkeys(parts))
    if not parts:
        return F.when(c.isNotNull(), False)
    return c.rlike("|".join(re.escape(p) for p in parts)) if len(parts) <= automaton.FEW else automaton.holds_any(c, parts)


# Workbook cells and tabs


def is_skipped_tab(sheet: Column) -> Column:
    return contains_any(lowered(sheet), L.SKIP_TABS)


def is_low_volume(sheet: Column) -> Column:
    return contains_any(lowered(sheet), ("below 10", "< 10", "<10"))


def tool_name(sheet: Column) -> Column:
    s = rf"(?U){SPACE}"
    c = F.regexp_replace(strip(sheet), rf"(?i){s}*-{s}*(10\+|below 10|less than 10|<{s}*10).*$", "")
    c = F.regexp_replace(c, rf"{s}*\(.*$", "")
    return strip(F.regexp_replace(c, rf"{s}*10\+{s}*$", ""))


def looks_like_keyword(v: Column) -> Column:
    letters = F.length(F.regexp_replace(v, r"[^\p{L}]", ""))
    slashes = F.length(v) - F.length(F.replace(v, F.lit("/")))
    return (F.length(v) <= 200) & ~starts_with_any(v, L.COMMAND_PREFIXES) & ~v.rlike(r"(?U)\A[\d.]+\Z") & (slashes <= 3) & (letters >= 3)


def cell_is_keyword(v: Column) -> Column:
    """Filters of an ordinary tab, on the stripped cell."""
    bold = v.startswith("**") & v.endswith("**")
    return ~F.lower(v).isin(*L.SKIP_VALUES) & (F.length(v) >= 3) & ~starts_with_any(v, L.CELL_PREFIXES) & ~bold & looks_like_keyword(v)


# Keys


def lookup(table: dict[str, str], w: Column, slots: int | None = None) -> Column:
    """The table's value for ``w``, else ``w``.

    Map literals are searched front to back, so the table is dealt into maps by CRC-32: a few entries each, however many there are.
    """
    slots = slots or max(64, len(table) // 8)
    dealt: list[dict[str, str]] = [{} for _ in range(slots)]
    for k, v in table.items():
        dealt[zlib.crc32(k.encode()) % slots][k] = v
    maps = F.from_json(F.lit(json.dumps(dealt, ensure_ascii=False)), "array<map<string,string>>")  # folds to one literal
    return F.coalesce(F.try_element_at(F.get(maps, (F.crc32(w.cast("binary")) % slots).cast("int")), w), w)


def replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Each pair's first text replaced by its second, one pair after the other."""
    if len(pairs) > automaton.FEW:
        return automaton.replaced_in_turn(c, pairs)
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, c)


def without_prefix(c: Column) -> Column:
    """Without the first question prefix that fits. One pattern, so ``c`` stands in the plan once."""
    return F.regexp_replace(c, rf"\A(?:{'|'.join(re.escape(p) for p in L.QUESTION_PREFIXES)})", "")


def without_articles(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\b({'|'.join(L.ARTICLES)})\b", " ")


def singular(w: Column) -> Column:
    n = F.length(w)
    cut = lambda k: F.substring(w, F.lit(1), n - k)
    return (
        F.when(w.endswith("ies") & (n > 4), F.concat(cut(3), F.lit("y")))
        .when(w.endswith("ses") & (n > 4), cut(2))
        .when(w.endswith("s") & ~w.endswith("ss") & ~w.endswith("us") & (n > 3), cut(1))
        .otherwise(w)
    )


def tool_variants(tool: Column) -> Column:
    """Spellings of a lower-cased tool name, longest first, then in code-point order."""
    words = split_words(tool)
    spelled = F.array(
        tool,
        F.when(tool.contains("."), F.replace(tool, F.lit("."), F.lit(""))),
        F.when(F.size(words) > 1, F.array_join(words, "")),
        F.concat(tool, F.lit(" software")),
        F.concat(tool, F.lit(" cloud")),
    )
    keyed = F.transform(F.array_distinct(F.filter(spelled, lambda v: v.isNotNull())), lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def phrase_text(keyword: Column, tool: Column) -> Column:
    """The keyword before it is split: lower case, tool names, question prefix and articles gone."""
    text = F.aggregate(tool_variants(F.lower(tool)), lowered(keyword), lambda t, v: F.replace(t, v, F.lit(" ")))
    return strip(rstrip_marks(without_articles(without_prefix(text))))


def keyword_key(keyword: Column, tool: Column, lex: Lexicon = DEFAULT) -> Column:
    """Sorted distinct canonical words of a keyword; empty if a spelling of the tool's name is empty."""
    text = replace_all(phrase_text(keyword, tool), lex.phrases(lex.verbs))
    words = F.transform(split_words(text), lambda w: lookup(lex.verbs, w))
    words = split_words(replace_all(F.array_join(words, " "), lex.phrases(lex.objects)))
    words = F.transform(words, lambda w: lookup(lex.objects, w))
    words = F.filter(words, lambda w: ~w.isin(*lex.stop_words) & (F.length(w) > 1))
    key = F.array_sort(F.array_distinct(F.transform(words, singular)))
    hollow = F.exists(tool_variants(F.lower(tool)), lambda v: v == "")
    return F.when(keyword.isNull() | tool.isNull(), None).when(hollow, F.array().cast("array<string>")).otherwise(key)


def title_key(title: Column, lex: Lexicon = DEFAULT) -> Column:
    """Key of a published title; null if nothing is left. Stop words go before synonyms, tool names and phrases stay."""
    words = split_words(rstrip_marks(without_articles(without_prefix(lowered(title)))))
    stops = [w for w in lex.stop_words if w not in L.TITLE_KEEPS]
    words = F.filter(words, lambda w: ~w.isin(*stops))
    words = F.transform(words, lambda w: singular(lookup(lex.objects, lookup(lex.verbs, w))))
    return F.when(F.size(words) > 0, F.array_sort(F.array_distinct(words)))


def key_string(key: Column) -> Column:
    return F.array_join(key, " ")


def lead_verb(key: Column, lex: Lexicon = DEFAULT) -> Column:
    """The key's first canonical verb in its order, null without one."""
    return F.get(F.filter(key, lambda w: w.isin(*lex.canonical_verbs)), F.lit(0))


# Labels


def category(keyword: Column) -> Column:
    c = F.lower(keyword)
    return (
        F.when(contains_any(c, L.INTEGRATION_SIGNALS), "integration")
        .when(starts_with_any(c, L.HOWTO_PREFIXES), "howto")
        .when(c.contains("tutorial"), "tutorial")
        .otherwise("other")
    )


def is_irrelevant(keyword: Column, tool: Column, lex: Lexicon = DEFAULT) -> Column:
    c, t = lowered(keyword), F.lower(tool)
    exact = [F.concat(F.lit(a), t, F.lit(b)) for a, b in (x.split("{}") for x in L.IRRELEVANT_TEMPLATES)]
    return c.isin(*exact) | contains_any(c, lex.irrelevant)


def signal(n: Column) -> Column:
    return F.when(n >= 5, "high").when(n >= 3, "medium").otherwise("low")


def quoted(c: Column) -> Column:
    """A Java regex that matches ``c`` literally."""
    return F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def suggested_title(canonical: Column, tool: Column) -> Column:
    """How-to titles get the tool in its own spelling, single spaces and the first word ``How``; others stay."""
    with_tool = F.when(F.length(tool) == 0, canonical).otherwise(F.call_function("array_join", F.split(canonical, F.concat(F.lit("(?iu)"), quoted(F.lower(tool))), -1), tool))
    words = split_words(with_tool)
    titled = F.array_join(F.concat(F.array(F.lit("How")), F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))), " ")
    return F.when(F.lower(canonical).startswith("how to"), titled).otherwise(canonical)


def safe_name(tool: Column) -> Column:
    return F.replace(strip(F.regexp_replace(tool, rf"(?U)[^\w{SPACE[1:-1]}.-]", "")), F.lit(" "), F.lit("_"))


def without_fence(c: Column) -> Column:
    """A reply without the Markdown fence around it."""
    body = F.regexp_replace(strip(c), r"\A```[^\n]*\n", "")
    return F.when(strip(c).startswith("```"), strip(F.regexp_replace(body, r"```\z", ""))).otherwise(strip(c))
