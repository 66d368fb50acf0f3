"""XML as a stream of tokens: where a document breaks, and what its elements hold, without a parser that may fail a job.

A document is cut into tags, comments and runs of text by one pattern that leaves nothing out. fault() runs a stack
automaton over them: its state is a path and a position, so a document of any length takes one pass. On a document without
fault, elements can then be found by patterns and by counting depth. Loops of the patterns are possessive: they neither
backtrack nor recurse, whatever the length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# Characters of XML, and those that begin and continue a name.
NO_CHARACTER = r"[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"
BEGINS = r"A-Za-z_:\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{2FF}\x{370}-\x{37D}\x{37F}-\x{1FFF}\x{200C}\x{200D}\x{2070}-\x{218F}\x{2C00}-\x{2FEF}\x{3001}-\x{D7FF}\x{F900}-\x{FDCF}\x{FDF0}-\x{FFFD}\x{10000}-\x{EFFFF}"
CONTINUES = BEGINS + r"\-.0-9\x{B7}\x{300}-\x{36F}\x{203F}\x{2040}"
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}

NAME = f"[{BEGINS}][{CONTINUES}]*+"
PLAIN_NAME = "[A-Za-z_:][A-Za-z0-9_:.-]*+"
QUOTED = "(?:\"[^\"<]*+\"|'[^'<]*+')"
#: A tag by its quotes and brackets, whatever else it has.
TAG = r"""</?[^<>!?"']++(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+>"""
TOKEN = rf"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|{TAG}|[^<]++|<"
REFERENCE = rf"&(?:{'|'.join(NAMED)}|#[0-9]++|#x[0-9A-Fa-f]++);"
#: Text, end tags, and tags of one attribute at most, with ASCII names and no reference.
BLAMELESS = rf"""^(?:[^<&\]]*+|</{PLAIN_NAME}\s*+>|<{PLAIN_NAME}(?:\s++{PLAIN_NAME}\s*+=\s*+(?:"[^"<&]*+"|'[^'<&]*+'))?+\s*+/?>)$"""
IN_TAG = r"""(?:\s(?:[^<>"'/]|"[^"]*+"|'[^']*+')*+)?"""
OTHER, TEXT, START, END, EMPTY = range(5)


def bare(xml: Column) -> Column:
    """XML without byte-order mark, declaration and DOCTYPE."""
    return F.regexp_replace(F.regexp_replace(xml, r"(?s)^\x{FEFF}?(?:<\?xml\s.*?\?>)?", ""), r"(?s)^((?:\s|<!--.*?-->)*+)<!DOCTYPE[^>\[]*+(?:\[.*?\]\s*)?>", "$1")


def tokens(xml: Column) -> Column:
    """Tags, comments, CDATA sections, instructions and runs of text in order; together they are xml."""
    return F.regexp_extract_all(xml, F.lit(TOKEN), F.lit(0))


def code_of(reference: Column) -> Column:
    """The code point of a numeric reference's digits (x before those of base 16)."""
    return F.when(reference.startswith("x"), F.conv(F.substr(reference, F.lit(2)), 16, 10)).otherwise(reference).try_cast("long")


def numeric(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("&#(x?[0-9A-Fa-f]++);"), F.lit(1))


def wrong_reference(text: Column) -> Column:
    """Whether & stands elsewhere than in the references that XML has without a DTD, or one names no character."""
    allowed = lambda c: c.isin(9, 10, 13) | c.between(0x20, 0xD7FF) | c.between(0xE000, 0xFFFD) | c.between(0x10000, 0x10FFFF)
    strange = F.exists(numeric(text), lambda r: ~F.coalesce(allowed(code_of(r)), F.lit(False)))
    return F.contains(text, F.lit("&")) & (F.contains(F.regexp_replace(text, REFERENCE, ""), F.lit("&")) | strange)


def well_named(token: Column, before: str, after: str) -> Column:
    """Whether a tag is `before`, a name and `after`, where NAME stands for a name; most names are ASCII, which is much cheaper to see."""
    pattern = lambda name: f"^{before}{name}{after.replace('NAME', name)}$"
    return token.rlike(pattern(PLAIN_NAME)) | token.rlike(pattern(NAME))


def wrong_start(tag: Column) -> Column:
    attributes = well_named(tag, "<", rf"(?:\s++NAME\s*+=\s*+{QUOTED})*+\s*+/?>")
    names = F.regexp_extract_all(tag, F.lit(rf"\s({NAME})\s*+=\s*+{QUOTED}"), F.lit(1))
    return ~attributes | F.when(tag.rlike("(?s)=.*="), F.size(names) > F.size(F.array_distinct(names))).otherwise(F.lit(False))


def wrong(token: Column) -> Column:
    """What is wrong with a token by itself; null if nothing, as one look says of most."""
    return F.when(~token.rlike(BLAMELESS), blame(token))


def blame(token: Column) -> Column:
    starts = lambda mark: token.startswith(mark)
    inner = F.substr(token, F.lit(5), F.length(token) - 7)
    return (
        F.when(~starts("<"), F.when(F.contains(token, F.lit("]]>")), "]]> in text").when(wrong_reference(token), "unknown reference"))
        .when(starts("</"), F.when(~well_named(token, "</", r"\s*+>"), "malformed end tag"))
        .when(starts("<!--"), F.when(F.contains(inner, F.lit("--")) | inner.endswith("-"), "-- in a comment"))
        .when(starts("<![CDATA["), F.lit(None))
        .when(starts("<?"), F.when(~token.rlike(rf"(?s)^<\?(?!(?i:xml)[\s?]){NAME}(?:\s.*)?\?>$"), "malformed instruction"))
        .when(wrong_start(token), "malformed tag")
        .when(wrong_reference(token), "unknown reference")
    )


def kind(token: Column) -> Column:
    """OTHER (comments, instructions, CDATA), TEXT, START, END or EMPTY."""
    return F.when(~token.startswith("<"), TEXT).when(token.startswith("</"), END).when(token.startswith("<!") | token.startswith("<?"), OTHER).when(token.endswith("/>"), EMPTY).otherwise(START)


def name_of(tag: Column) -> Column:
    return F.regexp_extract(tag, r"^</?([^\s/>]++)", 1)


def fault(xml: Column) -> Column:
    """Null for a well-formed document, else where it breaks and why, such as `17: </p> where </b> is due`.

    Namespaces aren't looked at. Declaration and DOCTYPE count as white space, and entities that one declares as unknown.
    """
    text = lambda c: F.lit(c).cast("string")
    state = lambda stack, roots, at, said: F.struct(stack.alias("stack"), roots.alias("roots"), at.alias("at"), said.alias("said"))
    solid = lambda t: t.startswith("<![CDATA[") | ~t.startswith("<") & (F.btrim(t, F.lit(" \t\r\n")) != "")

    def seen(v: Column) -> Column:
        """What the automaton reads: all but blameless text within the document; `at` counts tokens."""
        last = F.size(v["tokens"]) - 1
        facts = lambda t, i: F.struct(kind(t).alias("kind"), F.when(t.startswith("<"), name_of(t)).alias("name"), i.alias("at"), wrong(t).alias("wrong"), (F.when(t.startswith("<!") | (i == 0) | (i == last), solid(t)).otherwise(F.lit(False))).alias("solid"))
        return F.filter(F.transform(v["tokens"], facts), lambda t: (t["kind"] != TEXT) | t["wrong"].isNotNull() | t["solid"])

    def step(s: Column, t: Column) -> Column:
        outside = s["stack"] == ""
        broken = lambda said: state(s["stack"], s["roots"], t["at"], said)
        going = lambda stack, roots: state(stack, roots, s["at"], text(None))
        due = F.substring_index(s["stack"], "/", -1)
        mismatch = F.concat(F.lit("</"), t["name"], F.when(outside, F.lit("> where nothing is open")).otherwise(F.concat(F.lit("> where </"), due, F.lit("> is due"))))
        root = s["roots"] + F.when(outside, 1).otherwise(0)
        return (
            F.when(s["said"].isNotNull(), s)
            .when(t["wrong"].isNotNull(), broken(t["wrong"]))
            .when(outside & (s["roots"] > 0) & t["kind"].isin(START, EMPTY), broken(F.lit("a second root")))
            .when(t["kind"] == START, going(F.concat(s["stack"], F.lit("/"), t["name"]), root))
            .when((t["kind"] == END) & s["stack"].endswith(F.concat(F.lit("/"), t["name"])), going(F.substr(s["stack"], F.lit(1), F.length(s["stack"]) - F.length(t["name"]) - 1), s["roots"]))
            .when(t["kind"] == END, broken(mismatch))
            .when(t["kind"] == EMPTY, going(s["stack"], root))
            .when(outside & t["solid"], broken(F.lit("text outside the root")))
            .otherwise(s)
        )

    def end(v: Column) -> Column:
        def said(w: Column) -> Column:
            s = w["s"]
            size = F.aggregate(F.slice(v["tokens"], 1, F.coalesce(s["at"], F.size(v["tokens"]))), F.lit(1), lambda n, t: n + F.length(t))
            what = F.coalesce(s["said"], F.when(s["stack"] != "", F.concat(F.lit("not closed: "), F.substring_index(s["stack"], "/", -1))))
            return F.when(what.isNotNull(), F.concat(size.cast("string"), F.lit(": "), what)).when(s["roots"] == 0, "no root")

        return let(said, s=F.aggregate(seen(v), state(text(""), F.lit(0), F.lit(None).cast("int"), text(None)), step))

    def found(v: Column) -> Column:
        read = let(end, tokens=tokens(v["x"]))
        return F.when(v["x"].isNull(), "no document").when(v["x"].rlike(NO_CHARACTER), "a character that XML doesn't have").otherwise(read)

    return let(found, x=bare(xml))


def plain(xml: Column) -> Column:
    """A document of tags and text alone: CDATA sections as text, without comments and instructions."""
    inner = lambda t: F.replace(F.replace(F.replace(F.substr(t, F.lit(10), F.length(t) - 12), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    kept = lambda t: F.when(t.startswith("<![CDATA["), inner(t)).when(t.startswith("<!") | t.startswith("<?"), "").otherwise(t)
    return let(lambda v: F.when(v["x"].rlike("<[!?]"), F.array_join(F.transform(tokens(v["x"]), kept), "")).otherwise(v["x"]), x=bare(xml))


def decoded(text: Column) -> Column:
    """Text with its references as characters."""
    char = lambda r: F.decode(F.unhex(F.lpad(F.hex(code_of(r)), 8, "0")), "UTF-32")

    def named(t: Column) -> Column:
        for name, character in NAMED.items():
            t = F.replace(t, F.lit(f"&{name};"), F.lit(character))
        return t

    def all_of(v: Column) -> Column:
        numbers = F.aggregate(F.array_distinct(numeric(v["t"])), v["t"], lambda t, r: F.replace(t, F.concat(F.lit("&#"), r, F.lit(";")), F.when(code_of(r) == 38, "&amp;").otherwise(char(r))))
        return F.when(~F.contains(v["t"], F.lit("&")), v["t"]).otherwise(named(numbers))

    return let(all_of, t=text)


def text_of(inner: Column) -> Column:
    """All text of an element's content, references as characters."""
    return decoded(F.regexp_replace(inner, TAG, ""))


def escaped(value: Column) -> Column:
    """A value as text or attribute of a document: & < > and the double quote by reference."""
    for character, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        value = F.replace(value, F.lit(character), F.lit(f"&{name};"))
    return value


def raw_attribute(tag: Column, name: str) -> Column:
    """The attribute's value as it is written, for comparison with a word; null if the tag hasn't got it or it is empty."""
    before = rf"^<[^\s/>]++(?:\s++(?!{name}\s*+=)[^\s=]++\s*+=\s*+{QUOTED})*+\s++{name}\s*+=\s*+({QUOTED})"
    return let(lambda v: F.when(F.length(v["q"]) > 2, F.substr(v["q"], F.lit(2), F.length(v["q"]) - 2)), q=F.regexp_extract(tag, before, 1))


def attribute(tag: Column, name: str) -> Column:
    """The attribute's value; null if the tag hasn't got it or it is empty."""
    return decoded(raw_attribute(tag, name))


def first(xml: Column, name: str) -> Column:
    """The content of the first element of a name that doesn't hold itself; '' without one."""
    return F.regexp_extract(xml, rf"(?s)<{name}{IN_TAG}>(.*?)</{name}\s*+>", 1)


def tags(xml: Column, names: list[str]) -> Column:
    """The start tags of elements of these names, in document order."""
    return F.regexp_extract_all(xml, F.lit(rf"<(?:{'|'.join(names)}){IN_TAG}/?>"), F.lit(0))


def elements(xml: Column, name: str) -> Column:
    """(tag, inner) of the elements of a name that doesn't hold itself, in document order."""
    whole = F.regexp_extract_all(xml, F.lit(rf"(?s)<{name}{IN_TAG}(?:/>|>.*?</{name}\s*+>)"), F.lit(0))
    return F.transform(whole, lambda e: let(lambda v: F.struct(v["tag"].alias("tag"), F.regexp_replace(F.substr(e, F.length(v["tag"]) + 1), rf"</{name}\s*+>$", "").alias("inner")), tag=F.regexp_extract(e, rf"^<{name}{IN_TAG}/?>", 0)))


def children(fragment: Column) -> Column:
    """(name, tag, inner) of the elements at the top of a fragment without fault, in document order.

    For fragments of a bounded number of elements, such as a document's metadata; operators.trees has whole documents as rows.
    """
    node = "array<struct<name:string,tag:string,inner:string>>"
    state = lambda depth, at, tag, since, done: F.struct(depth.alias("depth"), at.alias("at"), tag.alias("tag"), since.alias("since"), done.alias("done"))

    def fold(v: Column) -> Column:
        def step(s: Column, t: Column) -> Column:
            at = s["at"] + F.length(t)
            made = lambda tag, inner: F.concat(s["done"], F.array(F.struct(name_of(tag).alias("name"), tag.alias("tag"), inner.alias("inner"))))
            inner = F.substr(v["x"], s["since"] + 1, s["at"] - s["since"])
            return (
                F.when(~t.startswith("<"), state(s["depth"], at, s["tag"], s["since"], s["done"]))
                .when(t.startswith("</"), state(s["depth"] - 1, at, s["tag"], s["since"], F.when(s["depth"] == 1, made(s["tag"], inner)).otherwise(s["done"])))
                .when(t.endswith("/>"), state(s["depth"], at, s["tag"], s["since"], F.when(s["depth"] == 0, made(t, F.lit(""))).otherwise(s["done"])))
                .otherwise(state(s["depth"] + 1, at, F.when(s["depth"] == 0, t).otherwise(s["tag"]), F.when(s["depth"] == 0, at).otherwise(s["since"]), s["done"]))
            )

        return F.aggregate(tokens(v["x"]), state(F.lit(0), F.lit(0), F.lit(""), F.lit(0), F.array().cast(node)), step, lambda s: s["done"])

    return let(fold, x=fragment)
