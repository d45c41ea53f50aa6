r"""Markup residue: find HTML, Markdown, wiki and LaTeX markup and turn it into clean text.

Template deduction over equivalence classes. A page (here: one field of one record) is
split into words and structure tokens, each with its own place in the text: what opens,
what closes, what stands alone. Structure tokens are differentiated by the path of
elements that are open around them; ends without a start are roles of their own. Over all
pages of a host (here: all fields of a volume) every token, words included, has an
occurrence vector, the number of times it occurs on each page. Tokens with equal vectors
form an equivalence class. A class is valid if two of its members at least are structure,
it is on enough pages, and its members stand in the same order on all of them. Valid
classes nest, by what is open around their members, into the host's template; a mark that
repeats a varying number of times (list items, table rows) is of the template if each of
its pages holds a valid class. What lies between template tokens are the slots:
``slots`` gives them, and ``cleaned`` writes the clean text from them.

No list of known marks decides what pairs: unknown syntax (``[b]...[/b]``, ``@@x@@``) is
markup as soon as its tokens form a valid class.

Exit. A piece that can share its vector with nothing cannot be deduced: an entity, a
``<br>``, an end without its start, and any mark on fewer pages than a class needs. There
the token's explicit syntax decides (``exits``); README gives the figures of both ways.

Occurrence vectors are never collected: a vector is its page count, its total and the
wrapping sum of hashes of its (page, count) cells, summed per partition before the
exchange, so a class is one ``groupBy`` over bounded token types. A class is no larger
than the tokens of one page; one whose elements change their order is split by element.

Not markup: brackets and signs of formulas (``{x | x ∈ M}``, ``<a, b>``, ``X^_ A``,
``__``, ``{{a},{b}}``), birth and death marks, ``2*3``, currency signs, a lone ampersand,
page numbers, enumeration marks.

Defined results: null or blank texts hold no markup; repeated rows count once; texts are
read whole; signs that are no accepted token stay in clean text as they are; an empty
table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaweave.operators.skew import sized
from lemmaweave.sources import cut

# The token syntax of the four markup languages, and of tokens like theirs.
LEXER = re.compile(
    r"""(?=[<&`{}\[\]|'=\#*~$\\_@%^:+!]|^[ \t0-9-]|\ [!|]{2})(?:(?P<comment><!--.*?-->|<!DOCTYPE[^>]*>)
    |(?P<tag></?[A-Za-z][A-Za-z0-9]*(?:\s+[^<>]*?)?\s*/?>)
    |(?P<entity>&(?:[A-Za-z][A-Za-z0-9]{1,31}|\#[0-9]{1,7}|\#[xX][0-9A-Fa-f]{1,6});)
    |(?P<fence>```|~~~)
    |(?P<code>`(?=(?P<code_>[^`\n]+)`))
    |(?P<wikitable>^\{\||^\|-|^\|\}|^!\ |\ !!\ |\ \|\|\ )
    |(?P<template>\{\{(?=[^\W\d_][\w .:-]*(?:\||\}\}))|(?<![{}\s,])\}\}(?!\}))
    |(?P<link>\[\[|\]\])
    |(?P<mdlink>!?\[(?=(?P<mdlink_>[^\[\]\n]*)\]\([^()\s]*\)))
    |(?P<wikiemph>'{2,5})
    |(?P<heading>^={2,6}(?=(?P<heading_>[^=\n]+)={2,6}[ \t]*$))
    |(?P<mdheading>^\#{2,6}[ ]+(?=\S)|^\#[ ]+(?=[A-ZÄÖÜ]))
    |(?P<strong>\*\*|(?<![A-Za-z0-9])~~(?=\S)|(?<=\S)~~)
    |(?P<displaymath>\$\$|\\\[|\\\]|\\\(|\\\))
    |(?P<math>\$(?=(?P<math_>\S[^$\n]*[\\^_{}=][^$\n]*|[\\^_{}=][^$\n]*)\$))
    |(?P<command>\\[A-Za-z]+\*?|\\[,;!%&_{}](?=.)|\\\\(?=\s*$))
    |(?P<emph>(?<![\w*])\*(?=(?P<star_>["„»›(]?[^\W\d_][^*\n†]{1,400}?(?<=[\w.)“«‹"]))\*(?![\w*]))
        |(?<![\w_^])_(?=(?P<line_>["„»›(]?[^\W_][^_\n]{1,400}?(?<=[\w.)“«‹"]))_(?![\w_])))
    |(?P<rule>^\|?(?::?-{3,}:?\|)+(?::?-{3,}:?)?[ \t]*$)
    |(?P<item>^[ \t]*[-*+\#][ ]+(?=[^\W\d])|^[ \t]*[0-9]{1,3}\.[ ]+(?=[^\W\d]))
    |(?P<row>^\|.*\|[ \t]*$)
    |(?P<other>[\[{@%]/?[A-Za-z][A-Za-z0-9]{0,15}[\]}@%]|(?<!\S)(?P<sign>[@%+^|!~:])(?P=sign)(?=\w)|(?<=\w)(?P<end>[@%+^|!~:])(?P=end)(?!\w)))
    """,
    re.X | re.M | re.S,
)
#: Marks that other text uses as well; they count as nested in a template only.
AMBIGUOUS = {"item", "row"}
TOGGLES = {"strong", "wikiemph", "displaymath", "fence"}
#: Marks whose end was found with their start: the group that lies between.
BODIES = {"code": ("code_",), "mdlink": ("mdlink_",), "heading": ("heading_",), "math": ("math_",), "emph": ("star_", "line_")}
VOID = {"br", "hr", "img", "meta", "link", "input"}
#: Elements whose content is no markup.
RAW = {"pre", "syntaxhighlight", "math", "verbatim", "nowiki", "code", "```", "~~~", "$", "$$", "\\[", "\\("}
WORD = re.compile(r"[^\W\d_]{2,}")
#: A text without any of these holds no structure token.
SIGNS = re.compile(r"[<&\[{'=#*~$\\`_@%|]|^[ \t]*(?:[-+]|[0-9]{1,3}\.)[ ]|(?<!\S)([+^!:])\1(?=\w)", re.M)
LEAST_PAGES = 3


class Token(NamedTuple):
    """A structure token: its place, kind, name, differentiated role, the role open around
    it, whether its syntax is explicit, and whether it has no counterpart on the page."""

    start: int
    end: int
    kind: str
    name: str
    role: str
    parent: str
    firm: bool
    alone: bool


def _lexed(text: str) -> Iterator[tuple[int, int, str, str, int]]:
    """(start, end, kind, name, step) of each token; step 1 opens, -1 closes, 0 neither."""
    taken: set[int] = set()  # where ends stand that were found with their start
    for hit in LEXER.finditer(text):
        word, a, b = hit.group(), hit.start(), hit.end()
        if a in taken:
            continue
        kind = next(k for k in LEXER.groupindex if hit.start(k) >= 0)
        if kind == "tag":
            name = re.match(r"</?([A-Za-z0-9]+)", word)[1].lower()  # type: ignore[index]
            if name == "a" and re.match(r"<a\s+[^=<>]*>", word):
                continue  # a pair in angle brackets, no attribute
            yield a, b, kind, name, 0 if name in VOID or word.endswith("/>") else -1 if word.startswith("</") else 1
        elif kind == "command":
            name = word.rstrip("*")
            if name in ("\\begin", "\\end"):
                env = re.compile(r"\{([A-Za-z]+\*?)\}(?:\{[^{}]*\})?").match(text, b)
                yield a, env.end() if env else b, kind, env[1] if env else "?", 1 if name == "\\begin" else -1
            elif word[1:2].isalpha() and (text[b : b + 1] == "{" or text[a - 1 : a] == "{" and a):
                inner = b if text[b : b + 1] == "{" else a - 1
                end = _closing(text, inner)
                if end is None:
                    yield a, b, kind, name, 0
                else:
                    taken.add(end)
                    yield min(a, inner), b + (inner == b), kind, name, 1
                    yield end, end + 1, kind, name, -1
            else:
                yield a, b, kind, name, 0
        elif kind in BODIES:
            group = next(g for g in BODIES[kind] if hit.group(g) is not None)
            end = hit.end(group)
            closing = re.compile(r"={2,6}|\]\([^()\s]*\)|.", re.S).match(text, end)
            assert closing is not None
            name = "$" if kind == "math" else "[" if kind == "mdlink" else "`" if kind == "code" else word[:6]
            if name in ("*", "_", "`", "$", "["):
                taken.update(range(end, closing.end()))
            yield a, b, kind, name, 1
            yield end, closing.end(), kind, name, -1
            if kind == "heading":
                taken.update(range(end, closing.end()))
        elif kind == "mdheading":
            end = text.find("\n", b)
            yield a, b, kind, word.strip(), 1
            yield (len(text), len(text), kind, word.strip(), -1) if end < 0 else (end, end + 1, kind, word.strip(), -1)
        elif kind in ("link", "template"):
            yield a, b, kind, word if word in ("[[", "{{") else {"]]": "[[", "}}": "{{"}[word], 1 if word in ("[[", "{{") else -1
        elif kind == "other":
            if word[0] in "[{@%" and len(word) > 2 and word[1:2].isalpha() | (word[1:2] == "/"):
                yield a, b, kind, word.replace("/", "", 1), -1 if word[1] == "/" else 1
            else:
                yield a, b, kind, word, -1 if hit.group("end") else 1
        elif kind == "displaymath" and word != "$$":
            yield a, b, kind, {"\\]": "\\[", "\\)": "\\("}.get(word, word), -1 if word in ("\\]", "\\)") else 1
        elif kind in TOGGLES:
            yield a, b, kind, word, 2
        else:
            yield a, b, kind, {"item": word.strip()[-1:], "wikitable": word.strip(), "entity": "&", "row": "|", "rule": "---"}.get(kind, kind), 0


def _closing(text: str, at: int) -> int | None:
    """Where the brace at ``at`` closes, in the same paragraph."""
    depth = 0
    for hit in re.compile(r"[{}]|\n\n").finditer(text, at):
        depth += 1 if hit.group() == "{" else -1
        if hit.group() == "\n\n":
            return None
        if not depth:
            return hit.start()
    return None


def tokens(text: str | None) -> list[Token]:
    """The structure tokens of a text in their order."""
    if not text or not SIGNS.search(text):
        return []
    raw = sorted(_lexed(text), key=lambda t: (t[0], t[1]))
    partner: dict[int, int] = {}
    steps = []
    open_: list[int] = []
    names: Counter[str] = Counter()
    inside: tuple[str, int] | None = None  # an element whose content is no markup
    kept: list[tuple[int, int, str, str]] = []
    for a, b, kind, name, step in raw:
        if kept and a < kept[-1][1]:
            continue
        if step == 2:
            step = -1 if names[name] else 1
        if inside and not (step == -1 and name == inside[0]):
            continue
        i = len(kept)
        kept.append((a, b, kind, name))
        steps.append(step)
        if step == 1:
            open_.append(i)
            names[name] += 1
            if name in RAW and text.find({"```": "```", "~~~": "~~~"}.get(name, ""), b) >= 0 and _ends(text, b, kind, name):
                inside = (name, i)
        elif step == -1:
            inside = None
            if names[name]:
                while kept[(j := open_.pop())][3] != name:
                    names[kept[j][3]] -= 1
                names[name] -= 1
                partner[i], partner[j] = j, i
    out: list[Token] = []
    path: list[tuple[str, str]] = []
    for i, ((a, b, kind, name), step) in enumerate(zip(kept, steps, strict=True)):
        paired = i in partner
        if kind == "other" and not paired:
            continue  # no token: such signs are text
        if step == -1 and paired:
            path.pop()
        where = "/".join(n for n, _ in path[-3:])
        role = f"{kind}:{'/' if step == -1 else ''}{name}@{where if paired or not step else '?'}"
        out.append(Token(a, b, kind, name, role, path[-1][1] if path else "", kind not in AMBIGUOUS and kind != "other", not paired))
        if step == 1 and paired:
            path.append((name, role))
    return out


def _ends(text: str, at: int, kind: str, name: str) -> bool:
    """Does an element with raw content end at all?"""
    ending = {"tag": f"</{name}", "command": f"\\end{{{name}}}", "displaymath": {"\\[": "\\]", "\\(": "\\)"}.get(name, name)}.get(kind, name)
    return text.find(ending, at) >= 0


# --- occurrence vectors -----------------------------------------------------------------


def long_fields(frame: DataFrame, keys: list[str], host: str, fields: list[str]) -> DataFrame:
    """Non-blank (keys, _host, field, text) and _page, which numbers distinct texts of a field."""
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields]))
    rows = frame.select(*keys, F.col(host).cast("string").alias("_host"), named.alias("_f")).select(*keys, "_host", "_f.field", "_f.text")
    return rows.where(F.length(F.trim("text")) > 0).withColumn("_page", F.xxhash64(*keys, "field", "text"))


def page_tokens(frame: DataFrame, keys: list[str], host: str, fields: list[str]) -> DataFrame:
    """What all steps read, made in one pass over the texts; to be materialised.

    Rows with ``n``: (keys, _host, field, _page, role, parent, firm, alone, first, n), the
    structure tokens of each page. Rows with ``pages``: (_host, role, pages, total, vector),
    the occurrence vectors of all tokens of the partition, words (roles without ``:``) included.
    """
    kinds = dict(frame.dtypes)
    columns = [*keys, "_host", "field", "_page", "role", "parent", "firm", "alone", "first", "n", "pages", "total", "vector"]
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "_host string, field string, _page long, role string, parent string, firm boolean, alone boolean, first int, n int, pages long, total long, vector long"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Per host: role -> [pages, total, vector]; a cell is the page's number times 2n + 1.
        hosts: dict[str | None, dict[str, list[int]]] = {}
        none = [None] * len(keys)
        types = {"_page": "Int64", "first": "Int32", "n": "Int32", "pages": "Int64", "total": "Int64", "vector": "Int64"}

        def flush() -> pd.DataFrame:
            rows = [(*none, h, None, None, r, None, None, None, None, None, p, t, (v + 2**63) % 2**64 - 2**63) for h, vectors in hosts.items() for r, (p, t, v) in vectors.items()]
            hosts.clear()
            return pd.DataFrame(rows, columns=columns).astype(types)

        for batch in batches:
            rows = []
            for *ids, host_, field, text, page in zip(*[batch[k] for k in keys], batch["_host"], batch["field"], batch["text"], batch["_page"], strict=True):
                found = tokens(text)
                firsts: dict[str, Token] = {}
                words = WORD.findall(blanked(text, found))
                counts: Counter[str] = Counter(words)
                vectors = hosts.setdefault(host_, {})
                for t in found:
                    counts[t.role] += 1
                    firsts.setdefault(t.role, t)
                rows += [(*ids, host_, field, page, r, t.parent, t.firm, t.alone, t.start, counts[r], None, None, None) for r, t in firsts.items()]
                once = 3 * page
                for role, n in counts.items():
                    at = vectors.get(role)
                    cell = once if n == 1 else page * (2 * n + 1)
                    if at is None:
                        vectors[role] = [1, n, cell]
                    else:
                        at[0] += 1
                        at[1] += n
                        at[2] += cell
            if rows:
                yield pd.DataFrame(rows, columns=columns).astype(types)
            if sum(map(len, hosts.values())) > 300_000:
                yield flush()
        if hosts:
            yield flush()

    return long_fields(frame, keys, host, fields).mapInPandas(read, schema)


def blanked(text: str, found: list[Token]) -> str:
    """A text with its structure tokens taken out."""
    if not found:
        return text
    ends = [0, *(t.end for t in found)]
    return " ".join(text[a:b] for a, b in zip(ends, [*(t.start for t in found), len(text)], strict=True))


def _structure(counted: DataFrame) -> DataFrame:
    return counted.where(F.col("n").isNotNull()).drop("pages", "total", "vector")


def classes(counted: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Valid equivalence classes: (_host, class_id, roles, words, n_pages, parent).

    ``roles``: structure members in their order; ``words``: members that are words;
    ``parent``: the role that is open around the class, '' at the top of the template.
    """
    # Equal vectors have equal parts in every partition, so their wrapped parts add up alike.
    whole = F.sum(F.col("vector").cast("decimal(38,0)"))
    vectors = counted.where(F.col("pages").isNotNull()).groupBy("_host", "role").agg(F.sum("pages").alias("pages"), F.sum("total").alias("total"), whole.alias("vector"))
    word = ~F.contains("role", F.lit(":"))  # roles of structure name their kind first
    grouped = vectors.where(F.col("pages") >= least_pages).groupBy("_host", "pages", "total", "vector")
    equal = grouped.agg(F.collect_list(F.when(~word, F.col("role"))).alias("members"), F.array_sort(F.collect_list(F.when(word, F.col("role")))).alias("words")).where(F.size("members") >= 2)
    equal = equal.select("_host", F.xxhash64("pages", "total", "vector", F.array_sort("members")).alias("class_id"), "members", "words")
    # Ordered: the first places of the members are in the same order on every page.
    equal = cut(equal, counted.sparkSession)
    member = sized(equal.select("_host", "class_id", F.explode("members").alias("role")))
    seen = _structure(counted).select("_host", "_page", "role", "first", "parent").distinct().join(member, ["_host", "role"])
    seen = cut(seen.withColumn("part", F.regexp_replace("role", ":/", ":")), counted.sparkSession)

    def ordered(by: list[str]) -> DataFrame:
        on_page = seen.groupBy("_host", *by, "_page").agg(F.array_sort(F.collect_list(F.struct("first", "role", "parent"))).alias("s"))
        order = on_page.select("_host", *by, F.transform("s", lambda x: x["role"]).alias("roles"), F.col("s")[0]["parent"].alias("parent"))
        same = order.groupBy("_host", *by).agg(F.min("roles").alias("roles"), F.max("roles").alias("_last"), F.count(F.lit(1)).alias("n_pages"), F.mode("parent", True).alias("parent"))
        return same.where((F.col("roles") == F.col("_last")) & (F.size("roles") >= 2) & (F.col("n_pages") >= least_pages)).drop("_last")

    whole_ = ordered(["class_id"])
    # Elements that merely occur equally often, in changing order, are classes of their own.
    parts = ordered(["class_id", "part"]).join(whole_.select("_host", "class_id"), ["_host", "class_id"], "left_anti")
    words = equal.select("_host", "class_id", "words")
    own = parts.select("_host", F.xxhash64("class_id", "part").alias("class_id"), "roles", "n_pages", "parent", F.array().cast("array<string>").alias("words"))
    return whole_.join(words, ["_host", "class_id"]).unionByName(own)


def template(counted: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(_host, role, nested): roles of the hosts' templates, members of valid classes and
    the repeating marks nested in them."""
    members = cut(classes(counted, least_pages).select("_host", F.explode("roles").alias("role")), counted.sparkSession)
    known = sized(members)
    pages = _structure(counted).select("_host", "_page", "role", "firm").distinct()
    # Valid classes are few roles a host, so these joins meet on pages, never on hosts.
    marked = pages.join(known, ["_host", "role"], "left_semi").select("_host", "_page", F.lit(1).alias("marked")).distinct()
    loose = pages.where(~F.col("firm")).join(known, ["_host", "role"], "left_anti")
    nested = loose.join(marked, ["_host", "_page"], "left").groupBy("_host", "role").agg(F.count(F.lit(1)).alias("k"), F.count("marked").alias("m"))
    nested = nested.where((F.col("k") == F.col("m")) & (F.col("k") >= least_pages)).select("_host", "role", F.lit(True).alias("nested"))
    return members.withColumn("nested", F.lit(False)).unionByName(nested)


def accepted(counted: DataFrame, keys: list[str], least_pages: int = LEAST_PAGES) -> DataFrame:
    """(keys, field, _page, role, way): the tokens that are markup, and by which way:
    ``deduced`` by the template, or ``exit`` by their explicit syntax."""
    rows = _structure(counted)
    roles = template(counted, least_pages).groupBy("_host", "role").agg(F.lit(True).alias("of_template"))
    support = rows.select("_host", "role", "_page").distinct().groupBy("_host", "role").agg(F.count(F.lit(1)).alias("k"))
    of_role = sized(cut(support.join(roles, ["_host", "role"], "left"), counted.sparkSession))
    judged = rows.join(of_role, ["_host", "role"])  # few roles, one of which may be on most pages
    exits = F.col("firm") & (F.col("alone") | (F.col("k") < least_pages))
    way = F.when(F.col("of_template"), "deduced").when(exits, "exit")
    return judged.select(*keys, "field", "_page", "role", way.alias("way")).where(F.col("way").isNotNull())


def found(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (keys, field) of the fields that hold markup, from ``page_tokens``."""
    return accepted(counted, keys).select(*keys, "field").distinct()


def ways(counted: DataFrame, keys: list[str]) -> DataFrame:
    """(way, n_fields): fields found by the template, and those found by the exit alone."""
    best = accepted(counted, keys).groupBy(*keys, "field").agg(F.min("way").alias("way"))
    return best.groupBy("way").agg(F.count(F.lit(1)).alias("n_fields"))


# --- slots and clean text -------------------------------------------------------------

BLOCK = {"p", "div", "section", "article", "table", "ul", "ol", "blockquote", "tr", "body", "html", "dl", "head"}
NOTES = {"ref", "\\footnote"}
CODE = {"pre", "syntaxhighlight", "verbatim", "```", "~~~"}
MATH = {"$", "$$", "\\[", "\\(", "math"}


def cut_slots(text: str, accept: Callable[[Token], bool]) -> list[tuple[Token | None, str]]:
    """(token, slot): each accepted token with the text from it to the next; what stands
    before the first token comes with None."""
    found = [t for t in tokens(text) if accept(t)]
    ends = [*(t.start for t in found), len(text)]
    return [(None, text[: ends[0]]), *((t, text[t.end : e]) for t, e in zip(found, ends[1:], strict=True))]


def to_text(text: str | None, accept: Callable[[Token], bool] = lambda t: True) -> str | None:
    """Clean text, written from the slots between accepted tokens; null stays null.

    Headings become ``# ...`` lines, list items ``- ...`` lines, table cells are joined by
    `` | ``, code keeps its lines between fences, formulas stand between ``$``, links and
    templates keep their last part, notes go.
    """
    if text is None:
        return None
    out: list[str] = []
    raw: list[str] = []  # code and formulas, set aside from the last tidying
    skip = 0
    body: str | None = None  # inside code or a formula
    for token, slot in cut_slots(text, accept):
        mark = ""
        if token is not None:
            ends = token.role.split(":", 1)[1].startswith("/") and not token.name.startswith("/")
            if token.name in NOTES and not token.alone:
                skip += -1 if ends else 1
            elif token.name in CODE | MATH and not token.alone:
                if ends and body is not None:
                    raw.append(f"```\n{html.unescape(re.sub(r'</?code[^>]*>', '', body)).strip(chr(10))}\n```" if token.name in CODE else f"${body.strip()}$")
                    mark = f"\n\n\ue000{len(raw) - 1}\ue001\n\n" if token.name in CODE else f"\ue000{len(raw) - 1}\ue001"
                    body = None
                elif not ends:
                    body = slot[slot.find("\n") + 1 :] if token.name in ("```", "~~~") and "\n" in slot else slot
                    continue
            else:
                mark = _mark(token, ends, text, "".join(out[-1:]))
                if token.name in ("[[", "{{") and not ends and not token.alone and "|" in slot:
                    slot = slot.rsplit("|", 1)[1] if token.name == "[[" else slot.split("|", 1)[1]
        if body is not None:
            body += text[token.start : token.end] + slot if token is not None else slot
        elif skip <= 0:
            out += [mark, slot]
        elif mark.strip("\n") and not slot:
            out.append("")
    t = "".join(out)
    if (again := html.unescape(t)) != t and re.search(r"</?[A-Za-z][^<>]*>", again):
        t = re.sub(r"</?[A-Za-z][A-Za-z0-9]*(?:\s+[^<>]*=[^<>]*)?\s*/?>", "", again)  # escaped tags
    t = re.sub(r"[ \t]+\n", "\n", re.sub(r"(?<=\S)[ \t]{2,}", " ", t))
    t = re.sub(r"\n{3,}", "\n\n", t).strip()
    return re.sub("\ue000([0-9]+)\ue001", lambda m: raw[int(m[1])] if int(m[1]) < len(raw) else m[0], t) if raw else t


def _mark(token: Token, ends: bool, text: str, before: str) -> str:
    """What an accepted token leaves in clean text."""
    kind, name = token.kind, token.name
    if kind == "tag":
        if re.fullmatch(r"h[1-6]", name):
            return "\n\n" if ends else f"\n\n{'#' * int(name[1])} "
        if name == "li":
            return "" if ends else "\n- "
        if name in ("td", "th"):
            return " | " if ends and re.match(r"\s*<t[dh]", text[token.end :]) else ""
        return "\n" if name == "br" else "\n\n" if name in BLOCK else ""
    if kind == "entity":
        return html.unescape(html.unescape(text[token.start : token.end])).replace("\xa0", " ")
    if kind in ("heading", "mdheading"):
        return "\n\n" if ends else f"\n\n{'#' * max(1, len(name) - (kind == 'heading'))} "
    if kind == "command":
        if name in ("\\section", "\\subsection", "\\subsubsection", "\\chapter"):
            return "\n\n" if ends else f"\n\n{'#' * (name.count('sub') + 1)} "
        if name == "\\item":
            return "- "
        if text.startswith(("\\begin", "\\end"), token.start):
            return "\n"
        return {"\\\\": "\n", "\\,": " ", "\\%": "%", "\\&": "&", "\\_": "_", "\\{": "{", "\\}": "}"}.get(name, "")
    if kind == "item":
        return text[token.start : token.end] if name == "." else "- "
    if kind == "row":
        return " | ".join(c.strip() for c in text[token.start : token.end].strip().strip("|").split("|"))
    if kind == "wikitable":
        return " | " if name in ("||", "!!") else ""
    return ""


def cleaned(frame: DataFrame, counted: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, fields): clean text of every field, from the tokens accepted on its page."""
    rows, ok = _with_roles(frame, counted, keys, fields)

    @F.pandas_udf("string")
    def convert(texts: pd.Series, roles: pd.Series) -> pd.Series:
        return pd.Series([t if r is None else to_text(t, lambda x, r=frozenset(r): x.role in r) for t, r in zip(texts, roles, strict=True)])

    done = rows.join(ok, "_page", "left").withColumn("text", convert(F.col("text"), F.col("roles")))
    wide = done.groupBy(*keys, "_row").agg(*[F.max(F.when(F.col("field") == f, F.col("text"))).alias(f) for f in fields])
    return wide.drop("_row")


def _with_roles(frame: DataFrame, counted: DataFrame, keys: list[str], fields: list[str]) -> tuple[DataFrame, DataFrame]:
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields]))
    rows = frame.withColumn("_row", F.xxhash64(*keys, *fields)).select(*keys, "_row", named.alias("_f")).select(*keys, "_row", "_f.field", "_f.text").distinct()
    ok = accepted(counted, keys).groupBy("_page").agg(F.collect_set("role").alias("roles"))
    return rows.withColumn("_page", F.xxhash64(*keys, "field", "text")), ok


def slots(frame: DataFrame, counted: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field, pos, role, slot): non-blank slots and the template token each follows."""
    rows, ok = _with_roles(frame, counted, keys, fields)

    @F.pandas_udf("array<struct<role:string,slot:string>>")
    def pieces(texts: pd.Series, roles: pd.Series) -> pd.Series:
        def one(text: str, ok_: frozenset[str]) -> list[dict[str, str]]:
            return [{"role": t.role if t else "", "slot": s.strip()} for t, s in cut_slots(text, lambda x: x.role in ok_) if s.strip()]

        return pd.Series([one(t, frozenset(r)) for t, r in zip(texts, roles, strict=True)], dtype=object)

    return rows.drop("_row").distinct().join(ok, "_page").select(*keys, "field", F.posexplode(pieces(F.col("text"), F.col("roles"))).alias("pos", "s")).select(*keys, "field", "pos", "s.role", "s.slot")


def clean(column: Column) -> Column:
    """``to_text`` of a column where no host is known: every explicit token is accepted."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: to_text(t, lambda x: x.firm), na_action="ignore")

    return convert(column)
