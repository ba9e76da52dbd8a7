"""Text in and out of nested messages held as JSON strings.

A message is a JSON string, an object with string content, or an object with a list of content blocks.  All that is not
replaced comes out byte for byte as it went in (see ``json_strings``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let
from .json_strings import message_strings, unescaped, unquoted, with_strings

# --- fixed value: separates the text blocks of one message
SEGMENT = "\u0000"
# ---


def text_in(message: Column, parts: Column) -> Column:
    """``extract_text`` of a message whose ``message_strings`` are known."""
    texts = F.transform(parts["texts"], lambda at: unquoted(F.get(parts["strings"], at)))
    return F.coalesce(F.when(parts["readable"], F.array_join(texts, SEGMENT)).otherwise(unescaped(message)), F.lit(""))


def text_replaced(message: Column, parts: Column, new: Column) -> Column:
    """``replace_text`` of a message whose ``message_strings`` are known."""
    segments = F.when(parts["blocks"], F.split(new, SEGMENT, -1)).otherwise(F.array(new))
    rewritten = F.when(F.size(parts["texts"]) > 0, let(segments, lambda each: with_strings(parts, each))).otherwise(message)
    return F.when(message.isNotNull(), F.when(parts["readable"], rewritten).otherwise(new))


def extract_text(message: Column | str) -> Column:
    """The text of a message; several blocks are joined by NUL so that offsets span all of them.

    Of repeated keys the last one counts.  What is no JSON at all is taken as plain text, so that it is searched too.
    """
    col = F.col(message) if isinstance(message, str) else message
    return let(message_strings(col), lambda parts: text_in(col, parts))


def replace_text(message: Column | str, redacted: Column | str) -> Column:
    """The message with its text, or its text blocks in order, replaced by ``redacted`` (its segments between NULs).

    A message without text is unchanged; one that is no JSON is replaced as a whole.
    """
    col = F.col(message) if isinstance(message, str) else message
    new = F.col(redacted) if isinstance(redacted, str) else redacted
    return F.when(col.isNotNull(), let(message_strings(col), lambda parts: text_replaced(col, parts, new)))
