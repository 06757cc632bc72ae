"""HTML character references decoded with built-in expressions, no Python worker."""

from __future__ import annotations

import html
import html.entities
import json
import zlib
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.bind import apply_sql, sql_let, sql_lookup, sql_raw

BUCKETS = 1024
# Fixed value: what a character reference looks like in running text (HTML5).
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _json_table(value: object, schema: str) -> str:
    """A constant table as SQL; the optimizer parses it once, when it folds constants."""
    return f"from_json({sql_raw(json.dumps(value).replace(chr(39), chr(92) + 'u0027'))}, '{schema}')"


@lru_cache(maxsize=1)
def _decoder_sql() -> str:
    """SQL lambda from a text with references to the decoded text."""
    names = html.entities.html5
    buckets: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    for name, value in names.items():
        buckets[zlib.crc32(name.encode()) % BUCKETS][name] = value
    named = _json_table(buckets, "array<map<string,string>>")
    # Numbers below 160 that do not stand for their own character, by asking the standard library.
    low = _json_table(
        {
            str(code): html.unescape(f"&#{code};")
            for code in range(160)
            if html.unescape(f"&#{code};") != chr(code)
        },
        "map<string,string>",
    )
    # Names valid without a semicolon; the longest one that begins a longer word is decoded.
    short = "|".join(sorted((n for n in names if not n.endswith(";")), key=len, reverse=True))

    def by_name(key: str) -> str:
        return sql_lookup("named", key, BUCKETS)

    # A leading space keeps U+FEFF from being taken for a byte-order mark.
    character = "substr(decode(unhex(concat('00000020', lpad(hex(code), 8, '0'))), 'UTF-32'), 2)"
    from_code = f"""case
        when code > 1114111 or code between 55296 and 57343 then '{chr(0xFFFD)}'
        when code < 160 then coalesce(try_element_at({low}, cast(code as string)), {character})
        when code between 64976 and 65007 or code & 65534 = 65534 then ''
        else {character} end"""
    # Anything over eight digits is out of range anyway.
    to_code = """case
        when length(digits) > 8 then 1114112L
        when lower(substr(ref, 3, 1)) = 'x' then cast(conv(concat('0', digits), 16, 10) as bigint)
        else cast(concat('0', digits) as bigint) end"""
    digits = f"regexp_extract(ref, {sql_raw('^&#[xX]?0*([0-9a-fA-F]*)')}, 1)"
    # The whole name, else its longest known beginning, else the reference as it stands.
    known = f"if({by_name('name')} is not null, name, regexp_extract(name, '^(?:{short})', 0))"
    from_name = sql_let(
        "known",
        known,
        f"if(known = '', ref, concat({by_name('known')}, substr(name, length(known) + 1)))",
    )
    decoded = f"""if(startswith(ref, '&#'),
        {sql_let('code', sql_let('digits', digits, to_code), from_code)},
        {sql_let('name', 'substr(ref, 2)', from_name)})"""
    rebuilt = f"""array_join(transform(split(text, {sql_raw(REFERENCE)}, -1), (piece, i) ->
        if(i = 0, piece, concat({sql_let('ref', 'get(refs, i - 1)', decoded)}, piece))), '')"""
    refs = f"regexp_extract_all(text, {sql_raw(REFERENCE)}, 0)"
    return "text -> " + sql_let("named", named, sql_let("refs", refs, rebuilt))


def html_unescape(text: Column) -> Column:
    """One pass of HTML5 character-reference decoding; text without ``&`` passes through as is."""
    return F.when(~F.contains(text, F.lit("&")), text).otherwise(apply_sql(text, _decoder_sql()))
