"""Text scalar functions: Unicode strip (G1), preview (G2), GB18030 decode."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens.functions.udf import arrow_udf
from twinlens.session import bounded_batches

# The characters Python's str.strip() removes (str.isspace()).
WHITESPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
STRIP_RE = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"
# The same 29 characters, spelled out for a character-set trim.
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                    + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()`` semantics, JVM-side.

    A character-set trim from both ends: no regex pass over the whole text.
    """
    return F.btrim(_col(c), F.lit(WHITESPACE_CHARS))


def preview(c: Column | str, n: int = 50) -> Column:
    return F.substring(_col(c), 1, n)


def is_blank(c: Column | str) -> Column:
    return F.length(strip_ws(c)) == 0


def _decode_series(b: pd.Series, encoding: str) -> pd.Series:
    def one(x):
        if x is None:
            return None
        s = bytes(x).decode(encoding, "ignore")
        # text-mode read: universal newlines
        s = s.replace("\r\n", "\n").replace("\r", "\n")
        return s
    return b.map(one)


@arrow_udf(T.StringType())
def _decode_gb18030(b: pd.Series) -> pd.Series:
    return _decode_series(b, "gb18030")


def decode_text(c: Column | str, encoding: str = "gb18030") -> Column:
    """Bytes -> text, malformed bytes dropped, then stripped (B4 + G1).

    Spark's ``decode`` does not know GB18030 and replaces rather than drops
    bad bytes, so the decode is an Arrow-batched UDF; the strip stays native.
    UTF-8 and the other charsets Spark knows decode natively.
    """
    enc = encoding.lower().replace("_", "-")
    if enc in ("utf-8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32"):
        text = F.decode(_col(c), enc)
        text = F.regexp_replace(text, "\r\n?", "\n")
    elif enc == "gb18030":
        bounded_batches(SparkSession.active())
        text = _decode_gb18030(_col(c))
    else:
        bounded_batches(SparkSession.active())

        @arrow_udf(T.StringType())
        def _dec(b: pd.Series) -> pd.Series:
            return _decode_series(b, encoding)
        text = _dec(_col(c))
    return strip_ws(text)


_REPORT = T.StructType([T.StructField("text", T.StringType()), T.StructField("ok", T.BooleanType())])


def decode_report(c: Column | str, encoding: str = "gb18030") -> Column:
    """``struct<text, ok>``: the text as ``decode_text`` gives it, and whether every byte was valid.

    One pass in Arrow batches: bytes that decode strictly are used as they are;
    only the others are decoded again with malformed sequences dropped. NULL
    bytes give NULL and false.
    """
    @arrow_udf(_REPORT)
    def report(b: pd.Series) -> pd.DataFrame:
        texts, oks = [], []
        for x in b:
            text, ok = None, False
            if x is not None:
                raw = bytes(x)
                try:
                    text, ok = raw.decode(encoding), True
                except UnicodeDecodeError:
                    text = raw.decode(encoding, "ignore")
                text = text.replace("\r\n", "\n").replace("\r", "\n")
            texts.append(text)
            oks.append(ok)
        return pd.DataFrame({"text": pd.Series(texts, dtype=object), "ok": pd.Series(oks, dtype=bool)})

    bounded_batches(SparkSession.active())
    found = report(_col(c))
    return F.struct(strip_ws(found["text"]).alias("text"), found["ok"].alias("ok"))


@arrow_udf(T.BinaryType())
def _encode_gb18030(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.encode("gb18030"))


def encode_gb18030(c: Column | str) -> Column:
    """Text -> GB18030 bytes (used to derive blobs from text tables)."""
    bounded_batches(SparkSession.active())
    return _encode_gb18030(_col(c))
