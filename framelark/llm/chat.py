"""Chat formatting: turns of a conversation become one string with marked turns and a loss mask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.llm.common import let

#: The template. Every conversation is BEGIN and its blocks. A block holds adjacent turns of one role, with NEXT between them.
BEGIN, NEXT = "<s>", "[NEXT]"
BLOCKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>"), "assistant": (" ", "</s>")}
#: A block of any other role names it.
OTHER = ("[ROLE] ", "[/ROLE]")
#: Control strings, each without the opening character that ESCAPE follows when it stands in a text.
CONTROL = r"([<\[])(?=/?s>|/?INST\]|/?<SYS>>|</SYS>>|NEXT\]|/?ROLE\])"
ESCAPE = "␛"
#: Stands, after ESCAPE, for a line feed in a role.
LINE_FEED = "␊"
#: Numbers that are added up one by one before sums of such stretches are.
STRETCH = 256


def escaped(text: Column) -> Column:
    """Doubles ESCAPE, then puts a single one inside each control string. unescaped() turns it back; no control string is left."""
    return F.regexp_replace(F.regexp_replace(text, ESCAPE, ESCAPE + ESCAPE), CONTROL, "$1" + ESCAPE)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, f"{ESCAPE}({ESCAPE}?)", "$1")


def escaped_role(role: Column) -> Column:
    """escaped(), and without line feeds, as one ends a role. A single ESCAPE stands nowhere else before that sign."""
    return F.regexp_replace(escaped(role), "\n", ESCAPE + LINE_FEED)


def unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(role, f"(?<!{ESCAPE})((?:{ESCAPE}{ESCAPE})*){ESCAPE}{LINE_FEED}", "$1\n"))


def merged(turns: Column) -> Column:
    """Array of (role, texts): adjacent turns of the same role in one element. turns is a sorted array of (turn, role, text)."""
    n = F.size(turns)

    def blocks(starts: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n + 1))
        return F.zip_with(
            starts, ends,
            lambda a, b: F.struct(
                F.element_at(turns, a)["role"].alias("role"),
                F.transform(F.slice(turns, a, b - a), lambda t: t["text"]).alias("texts"),
            ),
        )

    first = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"]))
    return let(first, blocks)


def marks(role: Column) -> tuple[Column, Column]:
    """What stands before and after the texts of a block."""
    before, after = F.concat(F.lit(OTHER[0]), escaped_role(role), F.lit("\n")), F.lit(OTHER[1])
    for name, (a, b) in BLOCKS.items():
        before, after = F.when(role == name, F.lit(a)).otherwise(before), F.when(role == name, F.lit(b)).otherwise(after)
    return before, after


def pieces(blocks: Column) -> Column:
    """Array of (role, before, text, after) for each turn in order: what stands in the formatted string, cut into turns."""

    def of_block(block: Column) -> Column:
        before, after = marks(block["role"])
        n = F.size(block["texts"])
        return F.transform(
            block["texts"],
            lambda t, i: F.struct(
                block["role"].alias("role"), F.when(i == 0, before).otherwise(F.lit(NEXT)).alias("before"), escaped(t).alias("text"),
                F.when(i == n - 1, after).otherwise(F.lit("")).alias("after"),
            ),
        )

    return F.flatten(F.transform(blocks, of_block))


def _sums_before(numbers: Column) -> Column:
    """For each number of an array the sum of those before it, one by one: the array grows at each step."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(numbers, start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all")))["all"]


def sums_before(numbers: Column, stretch: int = STRETCH) -> Column:
    """The same in stretches, so that only short arrays grow, and the sums of the stretches' sums."""
    last = F.greatest(F.floor((F.size(numbers) - 1) / stretch).cast("int"), F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(numbers, k * stretch + 1, F.lit(stretch)))

    def added(parts: Column) -> Column:
        total = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x))
        return F.flatten(F.zip_with(parts, _sums_before(total), lambda p, base: F.transform(_sums_before(p), lambda x: x + base)))

    return let(cut, added)


SPANS = "array<struct<start:int,length:int,byte_start:int,n_bytes:int>>"


def loss_spans(turns: Column, role: str) -> Column:
    """SPANS of the formatted string, in code points and in bytes of UTF-8: the escaped texts of the role, without what stands
    between. turns is an array as of pieces()."""

    def starts(size: Callable[[Column], Column]) -> Column:
        whole = F.transform(turns, lambda t: (size(t["before"]) + size(t["text"]) + size(t["after"])).cast("long"))
        return F.zip_with(turns, sums_before(whole), lambda t, at: (at + len(BEGIN) + size(t["before"])).cast("int"))

    both = F.zip_with(starts(F.length), starts(F.octet_length), lambda a, b: F.struct(a.alias("start"), b.alias("byte_start")))
    spans = F.zip_with(
        turns, both,
        lambda t, at: F.struct(
            t["role"].alias("role"), F.struct(at["start"].alias("start"), F.length(t["text"]).alias("length"), at["byte_start"].alias("byte_start"), F.octet_length(t["text"]).alias("n_bytes")).alias("span")
        ),
    )
    return F.transform(F.filter(spans, lambda s: s["role"] == role), lambda s: s["span"])


def format_chat(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each conv_id: formatted, and loss_spans, SPANS of formatted that count from 0.

    Turns are sorted by turn; ties by role, then text; a null turn comes first. Adjacent turns of one role share a block.
    Null text counts as empty, a null role as the empty role, a null conv_id is a conversation of its own. Repeated rows are
    turns like others. No rows give no rows. Other columns are ignored.
    A conversation becomes one string, so its turns meet in one row: that is the size of the result itself."""
    clean = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    convs = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    blocks = let(F.col("turns"), merged)

    def written(turns: Column) -> Column:
        text = F.array_join(F.transform(turns, lambda t: F.concat(t["before"], t["text"], t["after"])), "")
        return F.struct(F.concat(F.lit(BEGIN), text).alias("formatted"), loss_spans(turns, loss_role).alias("loss_spans"))

    return convs.select("conv_id", let(let(blocks, pieces), written).alias("w")).select("conv_id", "w.formatted", "w.loss_spans")


#: Finds the blocks of a formatted string. No text holds a closing string, so the nearest one ends its block.
_USER, _SYSTEM, _REPLY, _OTHER = r"\[INST\] .*? \[/INST\]", r"<<SYS>>\n.*?\n<</SYS>>", r" .*?</s>", r"\[ROLE\] .*?\[/ROLE\]"
PARSE = f"(?s)(?:{_USER}|{_SYSTEM}|{_REPLY}|{_OTHER})"


def read_back(formatted: Column) -> Column:
    """Array of (role, text) that formatted holds, with its texts unescaped: the turns as they were."""

    def turns(block: Column) -> Column:
        def cut(a: str, b: str) -> Column:
            return F.substring(block, F.lit(len(a) + 1), F.length(block) - len(a) - len(b))

        other = cut(*OTHER)
        role, body = unescaped_role(F.substring_index(other, "\n", 1)), F.substring(other, F.instr(other, "\n") + 1, F.length(other))
        for name, (a, b) in BLOCKS.items():
            role = F.when(block.startswith(a), F.lit(name)).otherwise(role)
            body = F.when(block.startswith(a), cut(a, b)).otherwise(body)
        return F.transform(F.split(body, r"\[NEXT\]", -1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    inner = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))
    return F.flatten(F.transform(F.regexp_extract_all(inner, F.lit(PARSE), F.lit(0)), turns))


def under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, spans joined with nothing between them. Bytes are cut without counting characters."""
    cut = lambda data: F.transform(spans, lambda s: unescaped(F.substring(data, s["byte_start"] + 1, s["n_bytes"]).cast("string")))
    return F.array_join(let(formatted.cast("binary"), cut), "")


def with_planted(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """turns and a conversation -1 whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(planted)


def digests(formatted: DataFrame) -> DataFrame:
    read = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
     e AS (SELECT *, len(replace(text, chr(9243), chr(9243) || chr(9243)))
                  + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[NEXT\]|\[ROLE\]|\[/ROLE\]')) AS n_esc,
                  len(replace(role, chr(9243), chr(9243) || chr(9243))) + len(role) - len(replace(role, chr(10), ''))
                  + len(regexp_extract_all(role, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[NEXT\]|\[ROLE\]|\[/ROLE\]')) AS n_role,
                  coalesce(lag(role) OVER w <> role, true) AS starts FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(n_esc + CASE WHEN NOT starts THEN 6 ELSE CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17
            WHEN 'assistant' THEN 5 ELSE 15 + n_role END END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
