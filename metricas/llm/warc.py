"""Derivatives of WARC responses: linked metadata records and plain-text conversion records.

Both name the response they come from (WARC-Refers-To), its target, date and
HTTP headers, and carry digests of their own block and of the source's payload.
All work is DataFrame expressions on whole records.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
# fixed values: elements that end a line of text, and character references that are resolved (& last)
BLOCKS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|"
          "li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul")
REFERENCES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
              ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"), ("&amp;", "&")]
# the characters of all named references; & stays a reference until the last step
NAMED = json.dumps({k: v.replace("&", "&amp;") for k, v in html.entities.html5.items() if k.endswith(";")})
# what 128 to 159 stand for in numeric references
WINDOWS = bytes(range(128, 160)).decode("cp1252", "replace")
LINKS = r"""(?i)<a(?=[\s/])[^>]*?(?<![\w-])href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
UNSEEN = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)"


def once(df: DataFrame, *columns) -> DataFrame:
    """``df.select(*columns)``, each column computed one time: a generator stands between, so
    that the optimiser copies no expression into the steps and filters that use it."""
    return df.select(F.explode(F.array(F.struct(*columns))).alias("one")).select("one.*")


def record_id(*parts: Column) -> Column:
    """A urn:uuid made from the parts, so that a record built again has the same id."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in
                    ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def headed(fields: list[tuple[str, Column]], block: Column) -> Column:
    """A whole record: version, named fields (those that are null are left out), block."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(CRLF * 2), block, F.lit(CRLF * 2))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id") -> DataFrame:
    """(page_id, url, html) -> (page_id, record): each page as a WARC response record.

    A page without html has an empty payload, one without url no target field.
    ``date`` is the capture date, which the table lacks.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(CRLF * 2), html)
    url = F.regexp_replace("url", r"[\r\n]+", " ")
    return (pages.select(F.col(id_col).alias("page_id"), url.alias("url"), html.alias("html"), http.alias("http"))
            .select("page_id", headed([
                ("WARC-Type", F.lit("response")),
                ("WARC-Record-ID", record_id(F.lit("response"), F.col("page_id").cast("string"), F.col("url"))),
                ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url")),
                ("WARC-Payload-Digest", digest(F.col("html"))),
                ("Content-Type", F.lit("application/http;msgtype=response")),
                ("Content-Length", F.octet_length("http").cast("string"))], F.col("http")).alias("record")))


def field(head: Column, name: str) -> Column:
    """A named field of a header block, null where absent; names ignore case."""
    value = F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def parsed(records: DataFrame) -> DataFrame:
    """(page_id, record) -> fields and payload of every response record; other types and malformed records go.

    A block longer than its Content-Length says is cut there.
    """
    cut = F.instr("record", CRLF * 2)
    head = F.expr(f"substring(record, 1, instr(record, '{CRLF * 2}') - 1)")
    block = F.expr(f"substring(record, instr(record, '{CRLF * 2}') + 4)")
    rows = (once(once(records, "page_id", "record").where(cut > 0), "page_id", head.alias("head"), block.alias("block"))
            .where(F.col("head").startswith("WARC/") & (F.lower(field(F.col("head"), "WARC-Type")) == "response")))
    size = field(F.col("head"), "Content-Length").try_cast("int")
    rows = rows.withColumn("block", F.when(F.octet_length("block") > size,
                                           F.expr("cast(block as binary)").substr(F.lit(1), size).cast("string"))
                           .otherwise(F.col("block")))
    rows = once(rows, "page_id", "head", "block", F.instr("block", CRLF * 2).alias("at"))
    return once(rows, "page_id", field(F.col("head"), "WARC-Record-ID").alias("source_id"),
                field(F.col("head"), "WARC-Target-URI").alias("target_uri"),
                field(F.col("head"), "WARC-Date").alias("date"),
                field(F.col("head"), "WARC-Payload-Digest").alias("payload_digest"),
                F.when(F.col("at") > 0, F.expr("substring(block, 1, at - 1)")).otherwise(F.col("block")).alias("http"),
                F.when(F.col("at") > 0, F.expr("substring(block, at + 4)")).otherwise(F.lit("")).alias("payload"))


def character(reference: Column) -> Column:
    """What a numeric or named reference stands for; an unknown name stays as it is."""
    hexadecimal = F.regexp_extract(reference, "^&#[xX]([0-9a-fA-F]+);$", 1)
    code = F.coalesce(F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)),
                      F.regexp_extract(reference, "^&#([0-9]+);$", 1)).try_cast("int")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return (F.when(code == 38, "&amp;").when(code == 160, " ")
            .when(code.between(128, 159), F.lit(WINDOWS).substr(code - 127, F.lit(1)))
            .when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
            .when(reference.startswith("&#"), "\ufffd")
            .otherwise(F.coalesce(F.try_element_at(F.from_json(F.lit(NAMED), "map<string,string>"), F.substring(reference, 2, 99)),
                                  reference)))


def resolved(text: Column) -> Column:
    """The text with all references but &amp; resolved."""
    parts = F.regexp_extract_all(text, F.lit(r"&(?:#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]++|&"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^&.+;$"), character(x)).otherwise(x)), "")


def seen(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    return F.regexp_replace(html, UNSEEN, "")


def plain_text(shown: Column) -> Column:
    """Visible text of a page without unseen parts, one line for each block of it.

    Numeric and named references are resolved if a semicolon ends them.
    """
    out = F.regexp_replace(shown, rf"(?i)</?(?:{BLOCKS})\b[^>]*+>", "\n")
    out = F.regexp_replace(out, r"<[a-zA-Z/!?][^>]*+>", "")
    for reference, char in REFERENCES[:-1]:
        out = F.replace(out, F.lit(reference), F.lit(char))
    # the others are rare: a text is only taken apart where it has some
    def some(x: Column) -> Column:  # plain searches first: most texts have no & left but &amp;
        return F.contains(F.replace(x, F.lit("&amp;"), F.lit("")), F.lit("&")) & x.rlike("&(?!amp;)[#A-Za-z]")
    out = F.transform(F.array(out), lambda x: F.when(some(x), resolved(x)).otherwise(x))[0]
    out = F.replace(out, F.lit(REFERENCES[-1][0]), F.lit(REFERENCES[-1][1]))
    out = F.regexp_replace(out, r"[ \t\r\f]*+\n\s*+", "\n")
    return F.btrim(out, F.lit(" \t\n\v\f\r"))


def derivatives(records: DataFrame) -> DataFrame:
    """(page_id, record) -> two derived records for each response: ``metadata`` and ``conversion``.

    The metadata block lists the source's HTTP status and headers, the page's
    title and the links of its a elements outside comments, scripts and styles in
    order, repeats included, with their values in either quotes or none, as they
    are written (a > in an attribute before href hides a link); the conversion
    block is the page's plain text. A response with an empty payload has an empty conversion.
    Repeated records give their derivatives each; an empty table gives none;
    other columns are ignored; null records go.

    Returns page_id, record_type, record_id, refers_to, target_uri, date,
    content_type, content_length, block_digest, payload_digest (the source's),
    block.
    """
    title = F.trim(F.regexp_extract("shown", r"(?is)<title[^>]*>([^<]*)", 1))
    links = F.transform(F.regexp_extract_all("shown", F.lit(LINKS), F.lit(1)),
                        lambda x: F.when(x.rlike("^[\"']"), x.substr(F.lit(2), F.length(x) - 2)).otherwise(x))
    lines = F.concat_ws(
        CRLF, F.concat(F.lit("http-status: "), F.regexp_extract("http", r"^HTTP/[0-9.]+ ([0-9]{3})", 1)),
        F.regexp_replace(F.regexp_replace("http", r"^HTTP/[^\r\n]*[\r\n]*", ""), r"(?m)^(?=[^\r\n])", "http-header-"),
        F.concat(F.lit("title: "), title), F.transform(links, lambda x: F.concat(F.lit("outlink: "), x)))
    rows = parsed(records)
    # the generator's array stands in the generator: of one in a column of its own Spark asks its size first,
    # and so computes both blocks twice
    both = once(rows, *rows.columns, seen(F.col("payload")).alias("shown")).select(
        "page_id", "source_id", "target_uri", "date", "payload_digest", F.explode(F.array(
            F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"),
                     lines.alias("block")),
            F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                     plain_text(F.col("shown")).alias("block")))).alias("derived"))
    return (both.select("page_id", "source_id", "target_uri", "date", "payload_digest", "derived.*")
            .select("page_id", "record_type", record_id(F.col("record_type"), F.col("source_id")).alias("record_id"),
                    F.col("source_id").alias("refers_to"), "target_uri", "date", "content_type",
                    F.octet_length("block").cast("long").alias("content_length"),
                    digest(F.col("block")).alias("block_digest"), "payload_digest", "block"))


def as_records(derived: DataFrame) -> DataFrame:
    """(page_id, record): the derived records in WARC form."""
    return derived.select("page_id", headed([
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("target_uri")), ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string"))], F.col("block")).alias("record"))
