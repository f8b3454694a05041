"""Checked options for reading and writing delimited text.

Both dataclasses can be built from keyword arguments or, as in ``DataFrameReader.options``, from a map of
strings (:meth:`ReadOptions.from_map`, :meth:`WriteOptions.from_map`).
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from locale import locale_alias

log = logging.getLogger(__name__)

PERMISSIVE, DROPMALFORMED, FAILFAST = "PERMISSIVE", "DROPMALFORMED", "FAILFAST"
MODES = (PERMISSIVE, DROPMALFORMED, FAILFAST)

QUOTE_MODES = ("ALL", "MINIMAL", "NON_NUMERIC", "NONE")

# The backslash spellings a delimiter option may use.
NAMED_DELIMITERS = {
    "\\t": "\t",
    "\\r": "\r",
    "\\b": "\b",
    "\\f": "\f",
    '\\"': '"',
    "\\'": "'",
    "\\u0000": "\u0000",
}

# Short codec names; any other name is handed to Spark as a codec class name.
CODECS = ("bzip2", "gzip", "lz4", "snappy")

# Marks that are read for one another, as texts rarely hold the exact one.
SIMILAR_MARKS = (" \u00a0\u202f", "\u2019'")


def delimiter_char(text: str) -> str:
    """One character, or one of the named escapes."""
    if not text:
        raise ValueError("Delimiter cannot be empty")
    if text.startswith("\\") and len(text) > 1:
        if text not in NAMED_DELIMITERS:
            raise ValueError(f"Unsupported special character for delimiter: {text}")
        return NAMED_DELIMITERS[text]
    if len(text) > 1:
        raise ValueError(f"Delimiter cannot be more than one character: {text}")
    return text


def single_char(label: str, text: str | None) -> str | None:
    """None (feature off) or exactly one character."""
    if text is not None and len(text) != 1:
        raise ValueError(f"{label} cannot be more than one character: {text!r}")
    return text


def flag(label: str, text: str | bool) -> bool:
    """Exactly true or false; no other spelling."""
    if isinstance(text, bool):
        return text
    if text not in ("true", "false"):
        raise ValueError(f"{label} flag can be true or false, not {text!r}")
    return text == "true"


def check_locale(locale: str) -> None:
    """Raise for an unknown locale. Without a running session only the name is checked, by the platform's table of languages."""
    from pyspark import SparkContext

    name = locale.replace("_", "-")
    if not re.fullmatch(r"[A-Za-z]{2,8}(-[A-Za-z0-9]{1,8})*", name):
        raise ValueError(f"unknown number locale {locale!r}")
    if SparkContext._active_spark_context is not None:
        number_marks(locale)
    elif name.split("-")[0].lower() not in LANGUAGES:
        raise ValueError(f"unknown number locale {locale!r}")


# The languages that the platform's own table of locales names, for checks before there is a session.
LANGUAGES = frozenset(re.split("[_.@]", alias)[0] for alias in locale_alias)


def number_marks(locale: str) -> tuple[str, str]:
    """(grouping marks, decimal mark) of a locale, from the symbol table of the JVM; each character of the first is a mark of its own."""
    from pyspark import SparkContext

    name = locale.replace("_", "-")
    if name.lower() in ("en", "en-us"):
        return ",", "."
    context = SparkContext._active_spark_context
    if context is None:
        raise RuntimeError(f"the marks of locale {locale!r} are read from a running session")
    if name not in _marks:
        java = context._jvm.java
        wanted = java.util.Locale.forLanguageTag(name)
        try:
            wanted.getISO3Language(), wanted.getISO3Country()
        except Exception:  # a language or region that does not exist
            raise ValueError(f"unknown number locale {locale!r}") from None
        symbols = java.text.DecimalFormatSymbols.getInstance(wanted)
        grouping, decimal = symbols.getGroupingSeparator(), symbols.getDecimalSeparator()
        _marks[name] = next((group for group in SIMILAR_MARKS if grouping in group), grouping), decimal
    return _marks[name]


_marks: dict[str, tuple[str, str]] = {}


def _lookup(cls, options: Mapping[str, str | None], names: Mapping[str, str]) -> dict:
    """Translate public option names (any case) to field names; names this class does not know are left out."""
    known = {public.lower(): field for public, field in names.items()}
    return {known[k.lower()]: v for k, v in options.items() if k.lower() in known}


# Public option names and the field each one sets.
READ_NAMES = {
    "delimiter": "delimiter",
    "sep": "delimiter",
    "quote": "quote",
    "escape": "escape",
    "comment": "comment",
    "header": "header",
    "mode": "mode",
    "charset": "charset",
    "encoding": "charset",
    "inferSchema": "infer_schema",
    "nullValue": "null_value",
    "dateFormat": "date_format",
    "treatEmptyValuesAsNulls": "treat_empty_values_as_nulls",
    "ignoreLeadingWhiteSpace": "ignore_leading_white_space",
    "ignoreTrailingWhiteSpace": "ignore_trailing_white_space",
    "maxCharsPerCol": "max_chars_per_col",
    "multiLine": "multi_line",
    "profile": "profile",
    "onBadCast": "on_bad_cast",
    "locale": "locale",
    "timestampNtz": "timestamp_ntz",
}

WRITE_NAMES = {
    "delimiter": "delimiter",
    "sep": "delimiter",
    "quote": "quote",
    "escape": "escape",
    "header": "header",
    "nullValue": "null_value",
    "dateFormat": "date_format",
    "quoteMode": "quote_mode",
    "codec": "codec",
    "compression": "codec",
    "maxRecordsPerFile": "max_records_per_file",
}


@dataclass(frozen=True)
class ReadOptions:
    """How to read delimited text.

    ``escape=None`` means that a quote inside a quoted field is written twice. ``profile`` picks the null and
    cast rules: ``standard`` follows ``null_value``/``treat_empty_values_as_nulls``/``date_format``;
    ``legacy`` treats the word ``null`` as null everywhere, takes a decimal comma and compact timestamps.
    ``on_bad_cast`` says what PERMISSIVE does with a token that does not fit its type: ``error`` or ``null``.
    """

    delimiter: str = ","
    quote: str | None = '"'
    escape: str | None = None
    comment: str | None = "#"
    header: bool = False
    mode: str = PERMISSIVE
    charset: str = "UTF-8"
    infer_schema: bool = False
    null_value: str | None = ""
    date_format: str | None = None
    treat_empty_values_as_nulls: bool = False
    ignore_leading_white_space: bool = False
    ignore_trailing_white_space: bool = False
    max_chars_per_col: int | None = None
    multi_line: bool = False
    profile: str = "standard"
    on_bad_cast: str = "error"
    locale: str = "en"
    timestamp_ntz: bool = False

    def __post_init__(self):
        put = lambda name, value: object.__setattr__(self, name, value)
        put("delimiter", delimiter_char(self.delimiter))
        put("quote", single_char("Quotation", self.quote or None))
        put("escape", single_char("Escape character", self.escape or None))
        put("comment", single_char("Comment marker", self.comment or None))
        for name in (
            "header",
            "infer_schema",
            "treat_empty_values_as_nulls",
            "ignore_leading_white_space",
            "ignore_trailing_white_space",
            "multi_line",
            "timestamp_ntz",
        ):
            put(name, flag(name, getattr(self, name)))
        try:
            put("max_chars_per_col", None if self.max_chars_per_col is None else int(self.max_chars_per_col))
        except (TypeError, ValueError):
            raise ValueError("maxCharsPerCol must be a valid integer") from None
        mode = str(self.mode).upper()
        if mode not in MODES:
            log.warning("%s is not a valid parse mode. Using %s.", self.mode, PERMISSIVE)
            mode = PERMISSIVE
        put("mode", mode)
        if self.profile not in ("standard", "legacy"):
            raise ValueError(f"profile can be standard or legacy, not {self.profile!r}")
        if self.on_bad_cast not in ("error", "null"):
            raise ValueError(f"on_bad_cast can be error or null, not {self.on_bad_cast!r}")
        check_locale(self.locale)

    @classmethod
    def from_map(cls, options: Mapping[str, str | None]) -> ReadOptions:
        return cls(**_lookup(cls, options, READ_NAMES))

    def but(self, **changes) -> ReadOptions:
        return replace(self, **changes)

    @property
    def escape_char(self) -> str | None:
        return self.escape or self.quote


@dataclass(frozen=True)
class WriteOptions:
    """How to write delimited text."""

    delimiter: str = ","
    quote: str | None = '"'
    escape: str | None = None
    header: bool = False
    null_value: str = "null"
    date_format: str = "yyyy-MM-dd HH:mm:ss.S"
    quote_mode: str | None = "MINIMAL"
    codec: str | None = None
    max_records_per_file: int | None = None

    def __post_init__(self):
        put = lambda name, value: object.__setattr__(self, name, value)
        put("delimiter", delimiter_char(self.delimiter))
        put("quote", single_char("Quotation", self.quote or None))
        put("escape", single_char("Escape character", self.escape or None))
        put("header", flag("header", self.header))
        try:
            put("max_records_per_file", None if self.max_records_per_file is None else int(self.max_records_per_file))
        except (TypeError, ValueError):
            raise ValueError("maxRecordsPerFile must be a valid integer") from None
        mode = (self.quote_mode or "MINIMAL").upper()
        if mode not in QUOTE_MODES:
            raise ValueError(f"unknown quoteMode {self.quote_mode!r}; known: {', '.join(QUOTE_MODES)}")
        if mode == "NONE" and self.escape is None:
            raise ValueError("quoteMode NONE needs an escape character")
        put("quote_mode", mode)
        if self.codec is not None:
            if self.codec.lower() in CODECS:
                put("codec", self.codec.lower())
            elif "." not in self.codec:
                raise ValueError(f"Codec [{self.codec}] is not available. Known codecs are {', '.join(CODECS)}.")

    @classmethod
    def from_map(cls, options: Mapping[str, str | None]) -> WriteOptions:
        return cls(**_lookup(cls, options, WRITE_NAMES))

    @property
    def escape_char(self) -> str | None:
        return self.escape or self.quote


def merged(cls, options, overrides: Mapping):
    """Options given as an object, a string map or keywords, in one call."""
    if options is None:
        base = cls()
    elif isinstance(options, cls):
        base = options
    else:
        base = cls.from_map(options)
    unknown = set(overrides) - {f.name for f in fields(cls)}
    if unknown:
        raise TypeError(f"unknown option(s): {', '.join(sorted(unknown))}")
    return replace(base, **overrides) if overrides else base


def required_path(options: Mapping[str, str | None]) -> str:
    path = {k.lower(): v for k, v in options.items()}.get("path")
    if not path:
        raise ValueError("'path' must be specified for delimited text.")
    return path
