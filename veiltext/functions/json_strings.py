"""The strings of a JSON text by their places, so that some can be replaced and all else stays as it came.

A text is cut at its strings in one search.  What lies between them (brackets, colons, numbers, blanks) tells which
string is which; it is never written anew.  So the order of keys, the form of numbers, blanks, repeated keys and the size
of a message play no part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import emit, fold_emit, let

# Possessive throughout: Java runs these without recursion, however long the string.
_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SOUND = r'\A"[^"\\\x00-\x1F]*+(?:\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4})[^"\\\x00-\x1F]*+)*+"\z'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][-+]?[0-9]++)?"
_ESCAPE = r"(?:\\u(?![dD][89a-fA-F])[0-9A-Fa-f]{4}|\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2})"  # a character

# --- fixed values: the names that messages are read by
CONTENT, TYPE, TEXT = "content", "type", "text"
# ---
_NAMES = (CONTENT, TYPE, TEXT)
# Which place of a string means what, at the end of the walk: a list of blocks, or no text at all.
_BLOCKS, _NOTHING = -1, -2
_ITEM = "struct<turn:int,place:int>"
# A string in the skeleton of a message: a letter for what it reads as (another one, content, type, text) and its place.
_MARKS = "ABCD"
# What the walk stops at: a key of the three names with its string or the bracket that it opens, and single brackets.
_TOKEN = r"[B-D][0-9]++:(?:[A-D][0-9]++|\[)?|[\[\]{}]"


def _name_pattern(name: str) -> str:
    """A JSON string that reads as the name, whichever of its letters are escaped."""
    hex_digit = lambda d: f"[{d}{d.upper()}]" if d.isalpha() else d
    letters = (rf"(?:{c}|\\u{''.join(map(hex_digit, f'{ord(c):04x}'))})" for c in name)
    return rf'\A"{"".join(letters)}"\z'


def _code(string: Column) -> Column:
    """1, 2 or 3 for ``content``, ``type`` and ``text``; else 0."""
    out = F.lit(0)
    for k, name in enumerate(_NAMES, 1):
        out = F.when(string.rlike(_name_pattern(name)), k).otherwise(out)
    # a name of seven letters, all escaped, has 44 characters
    return F.when(F.length(string) <= 44, out).otherwise(0)


def unquoted(string: Column) -> Column:
    """The value of a JSON string."""
    plain = string.substr(F.lit(2), F.length(string) - 2)
    read = F.get(F.from_json(F.concat(F.lit("["), string, F.lit("]")), "array<string>"), F.lit(0))
    return F.when(string.contains("\\"), read).otherwise(plain)


def quoted(value: Column) -> Column:
    """A value as a JSON string."""
    listed = F.to_json(F.array(value))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def _walk(tokens: Column) -> Column:
    """``turn, place`` of the text of each block, in order, and at the end the last turn with the place of its text.

    ``tokens`` are those of ``_TOKEN`` in a message.  A turn begins with each ``content`` of the message; the last one
    counts, as it does for readers of repeated keys.
    """

    def step(c: Column, i: Column) -> Column:
        def taken(token: Column, value: Column) -> Column:
            ch, at = F.left(token, F.lit(1)), c["depth"]
            string = F.when(value.rlike("^[A-D]"), F.substr(value, F.lit(2)).cast("int"))
            lists = token.endswith("[")
            in_block = c["block"] & (at == 3)
            begins = (ch == _MARKS[1]) & (at == 1) & c["object"]
            opens = (ch == "{") & (at == 2) & c["list"]
            closes = (ch == "}") & in_block
            again = (ch == _MARKS[3]) & in_block
            typing = (ch == _MARKS[2]) & in_block
            found = (
                F.when(closes & c["typed"] & (c["text"] >= 0), F.struct(c["turn"].alias("turn"), c["text"].alias("place")))
                .when(begins & (c["place"] >= 0), F.struct(c["turn"].alias("turn"), c["place"].alias("place")))
                .when(again & (c["text"] >= 0), F.struct(F.lit(-1).alias("turn"), c["text"].alias("place")))
            )
            down = ((ch == "{") | lists).cast("int") - ch.isin("}", "]").cast("int")
            carry = F.struct(
                (at + down).alias("depth"),
                (c["object"] | ((ch == "{") & (at == 0))).alias("object"),
                F.when(begins & lists, F.lit(True)).when((ch == "]") & (at == 2), F.lit(False)).otherwise(c["list"]).alias("list"),
                ((c["block"] | opens) & ~closes).alias("block"),
                F.when(opens, F.lit(False)).when(typing, value.startswith(_MARKS[3])).otherwise(c["typed"]).alias("typed"),
                F.when(opens, -1).when(again, F.coalesce(string, F.lit(-1))).otherwise(c["text"]).alias("text"),
                (c["turn"] + begins.cast("int")).alias("turn"),
                F.when(begins, F.when(lists, _BLOCKS).otherwise(F.coalesce(string, F.lit(_NOTHING)))).otherwise(c["place"]).alias("place"),
            )
            none = F.array().cast(f"array<{_ITEM}>")
            return emit(F.when(found.isNotNull(), F.array(found.cast(_ITEM))).otherwise(none), carry)

        return let(F.get(tokens, i), lambda token: let(F.split_part(token, F.lit(":"), F.lit(2)), lambda value: taken(token, value)))

    zero = dict(depth=0, object=False, list=False, block=False, typed=False, text=-1, turn=0, place=_NOTHING)
    start = F.struct(*(F.lit(v).alias(k) for k, v in zero.items()))
    end = lambda c: F.array(F.struct(c["turn"].alias("turn"), c["place"].alias("place")).cast(_ITEM))
    return fold_emit(F.size(tokens), _ITEM, start, step, end)


def message_strings(message: Column) -> Column:
    """``struct(gaps, strings, readable, blocks, texts, shadowed)`` of a message as JSON text.

    ``texts`` are the places of the strings that make its text: the message itself, its ``content``, or the ``text``
    of each block of type text in it (``blocks`` is true then).  ``shadowed`` are texts that a later key of the same name hides.
    """

    def read(gaps: Column, strings: Column) -> Column:
        # the same text with other strings, each key once, and plain numbers: is it JSON?
        numbered = F.transform(gaps, lambda g, i: F.concat(F.regexp_replace(g, _NUMBER, "0"), F.when(i < F.size(strings), F.concat(F.lit('"'), i, F.lit('"'))).otherwise("")))
        # an end of our own shows that it is one value and no more, as the reader stops after the first
        checked = F.try_parse_json(F.concat(F.lit("["), F.array_join(numbered, ""), F.lit(',"end"]')))
        single = F.coalesce(F.try_variant_get(checked, "$[1]", "string") == "end", F.lit(False))
        readable = single & F.forall(strings, lambda s: s.rlike(_SOUND))
        none = F.array().cast("array<int>")

        def skeleton(codes: Column) -> Column:
            mark = lambda i: F.concat(F.substr(F.lit(_MARKS), F.get(codes, i) + 1, F.lit(1)), i.cast("string"))
            bones = F.transform(gaps, lambda g, i: F.concat(F.regexp_replace(g, r"[^\[\]{}:,]+", ""), F.when(i < F.size(strings), mark(i)).otherwise("")))
            return F.array_join(bones, "")

        def found(codes: Column, bones: Column) -> Column:
            single = bones.rlike(r"\A[A-D]0\z")
            tokens = F.regexp_extract_all(bones, F.lit(_TOKEN), F.lit(0))
            walked = F.when(F.array_contains(codes, 1) & ~single, let(tokens, _walk)).otherwise(F.array().cast(f"array<{_ITEM}>"))

            def settle(items: Column) -> Column:
                end = F.element_at(items, -1)
                of = F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0)))
                mine = F.filter(of, lambda x: (x["turn"] == end["turn"]) & (end["place"] == _BLOCKS))
                texts = (
                    F.when(single, F.array(F.lit(0)))
                    .when(F.size(items) == 0, none)
                    .when(end["place"] >= 0, F.array(end["place"]))
                    .otherwise(F.transform(mine, lambda x: x["place"]))
                )
                hidden = F.transform(F.filter(of, lambda x: (x["turn"] != end["turn"]) | (end["place"] != _BLOCKS)), lambda x: x["place"])
                return F.struct(
                    gaps.alias("gaps"), strings.alias("strings"), F.lit(True).alias("readable"),
                    ((F.size(items) > 0) & F.coalesce(end["place"] == _BLOCKS, F.lit(False))).alias("blocks"), texts.alias("texts"), hidden.alias("shadowed"),
                )

            return let(F.when(F.size(walked) > 0, walked).otherwise(F.array().cast(f"array<{_ITEM}>")), settle)

        unread = F.struct(
            gaps.alias("gaps"), strings.alias("strings"), F.lit(False).alias("readable"), F.lit(False).alias("blocks"), none.alias("texts"), none.alias("shadowed")
        )
        known = let(F.transform(strings, _code), lambda codes: let(skeleton(codes), lambda bones: found(codes, bones)))
        return F.when(readable, known).otherwise(unread)

    pieces = F.struct(F.split(message, _STRING, -1).alias("g"), F.regexp_extract_all(message, F.lit(_STRING), F.lit(0)).alias("s"))
    return let(pieces, lambda p: read(p["g"], p["s"]))


def with_strings(parts: Column, segments: Column) -> Column:
    """The message of ``message_strings`` with its texts replaced, in order, by ``segments``; shadowed ones become empty.

    A string whose value does not change stays as it was written, and so do texts beyond the segments.
    """
    gaps, strings, texts = parts["gaps"], parts["strings"], parts["texts"]

    def changed(at: Column, k: Column) -> Column:
        old, segment = F.get(strings, at), F.get(segments, k)
        new = F.when(segment.isNull() | (unquoted(old) == segment), old).otherwise(quoted(segment))
        return F.struct(at.alias("at"), F.lit(1).alias("new"), new.alias("string"))

    old = F.transform(strings, lambda s, i: F.struct(i.alias("at"), F.lit(0).alias("new"), s.alias("string")))
    hidden = F.transform(parts["shadowed"], lambda at: F.struct(at.alias("at"), F.lit(1).alias("new"), F.lit('""').alias("string")))

    def built(every: Column) -> Column:
        # of an old and a new string of one place the new one comes later
        final = F.filter(every, lambda x, i: F.coalesce(F.get(every, i + 1)["at"] != x["at"], F.lit(True)))
        return let(
            F.transform(final, lambda x: x["string"]),
            lambda done: F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(done, i), F.lit("")))), ""),
        )

    return let(F.array_sort(F.concat(old, F.transform(texts, changed), hidden)), built)


def unescaped(text: Column) -> Column:
    """JSON that cannot be read as such, with its escapes written out, but for those of quotes, backslashes and controls.

    It is searched as it stands, so no value may hide behind an escape; what is written out is the same JSON.
    """
    escape = r"(?<=(?<!\\)(?:\\\\){0,64})" + _ESCAPE

    def shown(one: Column) -> Column:
        value = F.decode(F.unhex(F.replace(one, F.lit("\\u"), F.lit(""))), "UTF-16BE")
        return F.when(value.rlike(r'[\x00-\x1F"\\]'), one).otherwise(value)

    gaps, found = F.split(text, escape, -1), F.regexp_extract_all(text, F.lit(escape), F.lit(0))
    pieces = F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(shown(F.get(found, i)), F.lit(""))))
    return F.when(text.rlike(r"\A\s*[\[{\"]") & text.contains("\\u"), F.array_join(pieces, "")).otherwise(text)
