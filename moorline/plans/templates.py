"""Parameter placeholders in SQL text, bound as named parameters of ``spark.sql``."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from datetime import date
from decimal import Decimal

# The placeholder forms, most specific first.
#   ''" + context.k + "''    text
#   '" + context.k + "'      text
#   " + context.k + "        number or name
#   ${k}  context.k          text inside quotes, number or name outside
SPLICED = r"""(?P<splice>''"|'"|")[ ]\+[ ]context\.(?P<spliced>\w+)[ ]\+[ ](?:"''|"'|")"""
PLAIN = r"\$\{(?P<braced>[^}]*)\}|\bcontext\.(?P<dotted>\w+)"

TOKEN = re.compile(
    r"(?P<comment>--[^\n]*|/\*.*?\*/)"
    rf"|{SPLICED}"
    r"""|(?P<typed>\b(?:DATE|TIMESTAMP(?:_NTZ|_LTZ)?|TIME|INTERVAL)\s+)?"""
    r"""(?P<quoted>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`)"""
    rf"|{PLAIN}",
    re.DOTALL | re.IGNORECASE,
)
INNER = re.compile(PLAIN)
NUMBER = re.compile(r"[+-]?\d+(\.\d+)?")
NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*")


class _Parameters:
    def __init__(self, params: Mapping, plain: Iterable[str] = ()):
        self.plain = {name.lower() for name in plain}
        self.values: dict[str, object] = {}
        for name, value in params.items():
            if name.lower() in self.values:
                raise ValueError(f"parameter {name!r} is given twice, differing only in case")
            self.values[name.lower()] = value
        self.args: dict[str, object] = {}

    def find(self, name: str):
        key = name.strip().lower()
        if key not in self.values:
            raise ValueError(f"no value for placeholder {name.strip()!r}")
        return self.values[key]

    def bind(self, value) -> str:
        marker = f"param_{len(self.args)}"
        self.args[marker] = value
        return f":{marker}"

    def text(self, value) -> str:
        """A quoted value: always a string."""
        return self.bind(value if value is None else str(value))

    def bare(self, name: str) -> str:
        """An unquoted value: a typed literal, a number in text, or an identifier."""
        value = self.find(name)
        if value is None or isinstance(value, (bool, int, float, Decimal, date)):
            return self.bind(value)
        if NUMBER.fullmatch(str(value)):
            return self.bind(Decimal(value) if "." in value else int(value))
        if NAME.fullmatch(str(value)):
            return f"IDENTIFIER({self.bind(str(value))})"
        raise ValueError(f"placeholder {name!r} stands outside quotes, but its value is no number and no name: {value!r}")

    def quoted(self, token: str, typed: str | None) -> str:
        """A literal that is one placeholder becomes a bound string.

        Elsewhere inside quotes, and after a type name such as DATE where the grammar
        wants a literal, the value is escaped and stays within the quotes.
        """
        quote, whole = token[0], INNER.fullmatch(token, 1, len(token) - 1)
        if whole and quote != "`" and not typed and self.is_placeholder(whole):
            return self.text(self.find(whole["braced"] or whole["dotted"]))

        def inside(match: re.Match) -> str:
            if not self.is_placeholder(match):
                return match.group()
            value = str(self.find(match["braced"] or match["dotted"]))
            if quote == "`":
                return value.replace("`", "``")
            # The dollar sign too: Spark resolves ${...} in statement text by itself.
            return value.replace("\\", "\\\\").replace(quote, "\\" + quote).replace("$", "\\u0024")

        return (typed or "") + INNER.sub(inside, token)

    def is_placeholder(self, match: re.Match) -> bool:
        """Inside quotes ``context.x`` is plain text only if it was declared so."""
        return match["dotted"] is None or match["dotted"].lower() not in self.plain


def bind_template(text: str, params: Mapping | None = None, plain: Iterable[str] = ()) -> tuple[str, dict[str, object]]:
    """Statement with named parameters, and their values, for ``spark.sql(text, args)``.

    One pass over the text, so a value is never scanned again and a name never matches
    the start of a longer one. Names match ignoring case. A placeholder without a value
    raises, outside comments. Names in ``plain`` are none: inside quotes ``context.name``
    then stays as it is.
    """
    bound = _Parameters(params or {}, plain)

    def replace(match: re.Match) -> str:
        if match["comment"] is not None:
            return match.group()
        if match["spliced"] is not None:
            quoted = match["splice"] != '"'
            return bound.text(bound.find(match["spliced"])) if quoted else bound.bare(match["spliced"])
        if match["quoted"] is not None:
            return bound.quoted(match["quoted"], match["typed"])
        return bound.bare(match["braced"] if match["braced"] is not None else match["dotted"])

    return TOKEN.sub(replace, text), bound.args
