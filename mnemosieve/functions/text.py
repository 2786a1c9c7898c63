"""Tokens, digests, excerpts and small parsers as column expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seven ranges of CJK characters.
CJK = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2EBEF}\x{2F800}-\x{2FA1F}\x{30000}-\x{3134F}"
RUNS = rf"[{CJK}]+|[0-9A-Za-z]+"
# White space as the reader of records understands it.
SPACE = r"[\s\x{0B}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"
EXCERPT = 200


def text_of(c: Column) -> Column:
    """Null reads as the empty string."""
    return F.coalesce(c, F.lit(""))


def is_ascii_alnum(c: Column) -> Column:
    return c.rlike("^[0-9A-Za-z]$")


def is_cjk(c: Column) -> Column:
    return c.rlike(rf"^[{CJK}]$")


def tokens(text: Column, unigrams: bool = False) -> Column:
    """array<struct<token, kind>>: ASCII words of two letters or more ('a'), pairs of CJK characters ('b'), lone CJK characters ('u').

    unigrams: also each character of a longer CJK run, before that run's pairs.
    """
    def one(token: Column, kind: str) -> Column:
        return F.struct(token.alias("token"), F.lit(kind).alias("kind"))

    def run(r: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(r) - 1)
        pairs = F.transform(places, lambda i: one(r.substr(i, F.lit(2)), "b"))
        if unigrams:
            pairs = F.concat(F.transform(F.sequence(F.lit(1), F.length(r)), lambda i: one(r.substr(i, F.lit(1)), "u")), pairs)
        word = F.filter(F.array(one(F.lower(r), "a")), lambda x: F.length(r) >= 2)
        return F.when(r.rlike("^[0-9A-Za-z]"), word).when(F.length(r) == 1, F.array(one(r, "u"))).otherwise(pairs)

    text = text_of(text)
    mixed = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(RUNS), F.lit(0)), run))
    words = F.transform(F.regexp_extract_all(text, F.lit("[0-9A-Za-z]{2,}"), F.lit(0)), lambda r: one(F.lower(r), "a"))
    return F.when(text.rlike(f"[{CJK}]"), mixed).otherwise(words)  # most texts have no CJK run and need no look at each word


def n_tokens(text: Column) -> Column:
    """How many tokens() there are, without making one."""
    count = lambda pattern: F.regexp_extract_all(text_of(text), F.lit(pattern), F.lit(0))
    pairs = F.aggregate(count(f"[{CJK}]+"), F.lit(0), lambda n, r: n + F.greatest(F.length(r) - 1, F.lit(1)))
    return F.size(count("[0-9A-Za-z]{2,}")) + F.when(text_of(text).rlike(f"[{CJK}]"), pairs).otherwise(0)


def distinct_tokens(text: Column) -> Column:
    """Tokens in order of their first occurrence."""
    return F.array_distinct(tokens(text))


def token_key(token: Column) -> Column:
    return F.concat(token["kind"], F.char(F.lit(0)), token["token"])


def content_sha(title: Column, content: Column) -> Column:
    return F.sha2(F.concat(text_of(title), F.decode(F.unhex(F.lit("00")), "UTF-8"), text_of(content)), 256)


def document_text(title: Column, content: Column) -> Column:
    return F.concat(text_of(title), F.lit("\n"), text_of(content))


def excerpt(text: Column, limit: int = EXCERPT) -> Column:
    """White space collapsed, cut after `limit` code points with an ellipsis."""
    flat = F.trim(F.regexp_replace(text_of(text), SPACE, " "))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit), F.lit("…"))).otherwise(flat)


def blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(text_of(text), SPACE, " ")) == ""


def has_learnings_section(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?m)^##\s*Key Learnings\s*:?\s*$"), F.lit(False))


def capture_counts(result: Column) -> dict[str, Column]:
    """extracted, saved, duplicates of a capture's report; null where it has none."""
    pattern = r"extracted=(\d+)\s+saved=(\d+)\s+duplicates=(\d+)"
    number = lambda i: F.nullif(F.regexp_extract(result, pattern, i), F.lit("")).cast("long")
    return {"extracted": number(1), "saved": number(2), "duplicates": number(3)}


def truncate_to_budget(text: Column, budget: Column | int) -> Column:
    """Four UTF-16 units a token, with a note where something was cut. A character of two units isn't cut in half: it goes."""
    budget = budget if isinstance(budget, Column) else F.lit(budget)
    most = F.greatest(F.lit(0), F.floor(budget * 4)).cast("int")
    units = F.encode(text, "UTF-16BE")
    half = F.hex(F.substring(units, 2 * most - 1, F.lit(2))).between("D800", "DBFF") & (most > 0)
    first = F.decode(F.substring(units, F.lit(1), 2 * most - F.when(half, 2).otherwise(0)), "UTF-16BE")
    wide = text.rlike("[\\x{10000}-\\x{10FFFF}]")
    fits = F.when(wide, F.octet_length(units) <= 2 * most).otherwise(F.length(text) <= most)
    cut = F.when(wide, first).otherwise(F.left(text, most))
    return F.when(fits, text).otherwise(F.concat(cut, F.lit("\n…(truncated to "), budget.cast("string"), F.lit(" tokens)")))


def recall_budget(budget: Column | int, frame: str) -> Column:
    """What a frame leaves of a token budget."""
    budget = budget if isinstance(budget, Column) else F.lit(budget)
    return F.greatest(F.lit(0), budget - F.lit(-(-len(frame) // 4)))


def framed_recall(text: Column, frame: str, budget: Column | int) -> Column:
    return F.concat(F.lit(frame + "\n\n"), truncate_to_budget(text, recall_budget(budget, frame)))


def blocks_to_text(blocks: Column) -> Column:
    """Texts of the blocks of type text, a line each."""
    chosen = F.filter(blocks, lambda b: (b["type"] == "text") & b["text"].isNotNull())
    return F.coalesce(F.array_join(F.transform(chosen, lambda b: b["text"]), "\n"), F.lit(""))


def parse_envelope(text: Column) -> Column:
    """struct<project, project_source, result> of a response; text that isn't a JSON object is the result itself."""
    parsed = F.from_json(text, "project string, project_source string, result string")
    whole = F.get_json_object(text, "$").startswith("{") & F.trim(text).startswith("{")
    field = lambda name: F.when(whole, F.nullif(parsed[name], F.lit("")))
    return F.struct(field("project").alias("project"), field("project_source").alias("project_source"), F.coalesce(F.when(whole, parsed["result"]), text).alias("result"))


def tool_mentions(text: Column, prefix: str = "") -> Column:
    """Names of memory tools mentioned in a line."""
    return F.regexp_extract_all(text_of(text), F.lit(rf"(?:{prefix})?mem_[a-z0-9_]+" if prefix else r"mem_[a-z0-9_]+"), F.lit(0))


def write_endpoint(url: Column) -> Column:
    return F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/observations"))


def score_text(score: Column) -> Column:
    return F.format_string("%.4f", score.cast("double"))


def float_text(value: Column) -> Column:
    """A double with its decimal point: 3 is 3.0."""
    return value.cast("double").cast("string")
