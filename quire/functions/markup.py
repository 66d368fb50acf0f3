"""HTML bodies as journal-article XML by column expressions: the stages that act on tags, in their order.

Each stage is a pure expression, so the whole pipeline stays in the JVM and one scan. What needs the tree around a
node (assets with captions, footnotes moved between siblings) is not done here; README.md lists it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# HTML elements and what each becomes.
UNWRAPPED = ["font", "small", "big", "dir", "span", "s", "lixo", "center"]
RENAMED = [
    ("i", "italic", ""),
    ("em", "italic", ""),
    ("b", "bold", ""),
    ("strong", "bold", ""),
    ("u", "underline", ""),
    ("ol", "list", ' list-type="order"'),
    ("ul", "list", ' list-type="bullet"'),
    ("dl", "def-list", ""),
    ("dd", "def-item", ""),
    ("blockquote", "disp-quote", ""),
    ("div", "p", ""),
]
EMPTY_STAYS = ["a", "br", "break", "img", "hr", "td", "body"]


def tag(name: str) -> str:
    return rf"(?i)<(/?){name}(?=[\s/>])[^>]*>"


def drop_elements(html: Column, names: list[str]) -> Column:
    """Without these elements and what they hold."""
    for name in names:
        html = F.regexp_replace(html, rf"(?is)<{name}(?=[\s>])[^>]*>.*?</{name}\s*>", " ")
    return html


def element(html: Column, name: str) -> Column:
    """What the first element of that name holds; '' if there is none."""
    return F.regexp_extract(html, rf"(?is)<{name}(?=[\s>])[^>]*>(.*?)</{name}\s*>", 1)


def remove_comments(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def unwrap(html: Column, names: list[str] = UNWRAPPED) -> Column:
    return F.regexp_replace(html, rf"(?i)</?(?:{'|'.join(names)})(?=[\s/>])[^>]*>", "")


def drop_style(html: Column) -> Column:
    """style attributes go, but for those of tables and their parts."""
    return F.regexp_replace(html, r"""(?i)(<(?!(?:table|thead|tbody|tfoot|tr|td|th|col|colgroup|caption|hr)\b)[a-z][^>]*?)\s+style\s*=\s*(?:"[^"]*"|'[^']*')""", "$1")


def src_to_href(html: Column) -> Column:
    """Links that have src and no href."""
    return F.regexp_replace(html, r"(?i)<a\b((?:(?!href)[^>])*?)\bsrc\s*=", "<a$1href=")


def rename(html: Column) -> Column:
    """Elements by their new names; a page is only searched for those that it may have."""
    steps = []
    for old, new, more in RENAMED:
        steps += [(f"<{old}", rf"(?i)<{old}(?=[\s/>])[^>]*>", f"<{new}{more}>"), (f"</{old}", rf"(?i)</{old}\s*>", f"</{new}>")]
    steps += [("<li", r"(?i)<li(?=[\s/>])[^>]*>", "<list-item><p>"), ("</li", r"(?i)</li\s*>", "</p></list-item>")]
    steps += [("<h", r"(?i)<h([1-6])(?=[\s/>])[^>]*>", '<p content-type="h$1">'), ("</h", r"(?i)</h[1-6]\s*>", "</p>"), ("<hr", r"(?i)<hr(?=[\s/>])[^>]*>", '<p content-type="hr"/>')]

    def renamed(v: Column) -> Column:
        def step(html: Column, mark: str, pattern: str, by: str) -> Column:
            return let(lambda w: F.when(F.contains(v["lower"], F.lit(mark)), F.regexp_replace(w["html"], pattern, by)).otherwise(w["html"]), html=html)

        done = v["html"]
        for mark, pattern, by in steps:  # none makes what another looks for, so the page as it was says what is there
            done = step(done, mark, pattern, by)
        return done

    return let(renamed, html=html, lower=F.lower(html))


def links(html: Column) -> Column:
    """Links as email or ext-link by the shape of their href; links within the page as xref."""
    html = F.regexp_replace(html, r"""(?is)<a\b[^>]*?href\s*=\s*["']?mailto:([^"'>\s]+)["']?[^>]*>(.*?)</a\s*>""", '<email xlink:href="$1">$2</email>')
    html = F.regexp_replace(html, r"""(?is)<a\b[^>]*?href\s*=\s*["']#([^"'>]*)["'][^>]*>(.*?)</a\s*>""", '<xref rid="$1">$2</xref>')
    return F.regexp_replace(html, r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"'>]*)["'][^>]*>(.*?)</a\s*>""", '<ext-link ext-link-type="uri" xlink:href="$1">$2</ext-link>')


def breaks(html: Column) -> Column:
    """br as break inside titles, labels and cells' text; elsewhere paragraphs are split there."""
    html = F.regexp_replace(html, r"(?i)(<p(?=[\s>])[^>]*>)\s*(?:<br\s*/?>\s*)+", "$1")
    html = F.regexp_replace(html, r"(?i)(?:\s*<br\s*/?>)+\s*(</p\s*>)", "$1")
    return F.regexp_replace(html, r"(?i)\s*<br\s*/?>\s*", '</p><p content-type="break">')


def images(html: Column) -> Column:
    """img as inline-graphic, as graphic where it is a paragraph's only content."""
    html = F.regexp_replace(html, r"""(?i)(<p(?=[\s>])[^>]*>)\s*<img\b[^>]*?src\s*=\s*["']([^"'>]*)["'][^>]*>\s*(</p>)""", '$1<graphic xlink:href="$2"/>$3')
    return F.regexp_replace(html, r"""(?i)<img\b[^>]*?src\s*=\s*["']([^"'>]*)["'][^>]*>""", '<inline-graphic xlink:href="$1"/>')


def until_gone(html: Column, pattern: str, by: str, passes: int) -> Column:
    """html with a pattern replaced until it doesn't occur: in a few passes, and the rare deeper nesting by a fold."""
    for _ in range(passes):
        html = F.regexp_replace(html, pattern, by)

    def rest(v: Column) -> Column:
        ends = F.sequence(F.lit(1), F.size(F.split(v["html"], "</")))
        return F.when(v["html"].rlike(pattern), F.aggregate(ends, v["html"], lambda h, _: F.regexp_replace(h, pattern, by))).otherwise(v["html"])

    return let(rest, html=html)


def drop_empty(html: Column) -> Column:
    """Elements without content, but for those that may be empty, at any depth."""
    keep = "|".join(EMPTY_STAYS)
    return until_gone(html, rf"(?i)<(?!(?:{keep})\b)([a-z][a-z-]*)(?:\s+[^>/]*)?>\s*</\1\s*>", "", 4)


def unnest_paragraphs(html: Column) -> Column:
    """A paragraph that holds nothing but one paragraph is that one, at any depth."""
    return until_gone(html, r"(?is)<p(?:\s[^>]*)?>\s*(<p(?:\s[^>]*)?>(?:(?!</?p\b).)*</p>)\s*</p>", "$1", 3)


def fix_ids(html: Column, body: Column) -> Column:
    """id and rid in lower case, letters, digits and _ only, from a letter on; -bodyN from the second body on."""
    suffix = F.when(body > 1, F.concat(F.lit("-body"), body.cast("string"))).otherwise("")
    parts = F.regexp_extract_all(html, F.lit(r"""\b(?:id|rid)="[^"]*"|(?s).(?:(?!\b(?:id|rid)=").)*"""), F.lit(0))

    def fixed(part: Column) -> Column:
        value = F.lower(F.regexp_replace(F.regexp_extract(part, '"([^"]*)"', 1), r"[^A-Za-z0-9_]", ""))
        value = F.when(value.rlike("^[a-z]"), value).otherwise(F.concat(F.lit("replaced_by_"), value))
        return F.when(part.rlike('^(?:id|rid)="'), F.concat(F.regexp_extract(part, "^(id|rid)=", 1), F.lit('="'), value, suffix, F.lit('"'))).otherwise(part)

    return F.array_join(F.transform(parts, fixed), "")


#: The stages in order; each takes and returns HTML.
STAGES = [
    ("a_src", src_to_href),
    ("comments", remove_comments),
    ("scripts", lambda h: drop_elements(h, ["script", "style"])),
    ("deprecated", unwrap),
    ("style_attributes", drop_style),
    ("links", links),
    ("rename", rename),
    ("images", images),
    ("breaks", breaks),
    ("empty", drop_empty),
    ("nested_p", unnest_paragraphs),
]


def to_article_body(html: Column, body: Column) -> Column:
    for _, stage in STAGES:
        html = stage(html)
    return F.trim(F.regexp_replace(fix_ids(html, body), r"\s+", " "))


def unescape(text: Column) -> Column:
    """The entities that pages use as characters; &lt; &gt; &amp; last, so that nothing is decoded twice."""
    for entity, char in (("&nbsp;", " "), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def safe_decode(text: Column) -> Column:
    """Entities as characters, save those that XML itself needs."""
    for entity, char in (("&nbsp;", " "), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&eacute;", "é"), ("&atilde;", "ã"), ("&ccedil;", "ç")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def text_of(html: Column) -> Column:
    """The text of HTML: tags as spaces, entities as characters, single spaces."""
    bare = F.regexp_replace(drop_elements(remove_comments(html), ["script", "style"]), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(unescape(bare), r"\s+", " "))


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*"([^"]*)\""""), F.lit(1))


def link_class(href: Column, host: Column) -> Column:
    """asset, pdf, html, internal, external or unknown."""
    path = F.regexp_replace(href, r"[?#].*$", "")
    return (
        F.when(href.startswith("#"), "internal")
        .when(href.rlike("(?i)^mailto:|@"), "external")
        .when(href.rlike("(?i)^[a-z]+://") & ~F.coalesce(href.contains(host), F.lit(False)), "external")
        .when(path.rlike(r"(?i)\.pdf$"), "pdf")
        .when(path.rlike(r"(?i)\.(jpg|jpeg|gif|png|tif|tiff|svg)$"), "asset")
        .when(path.rlike(r"(?i)\.html?$"), "html")
        .when(href.startswith("/"), "html")
        .otherwise("unknown")
    )
