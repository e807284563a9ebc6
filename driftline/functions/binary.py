"""Row keys, typed bytes and frames. Row keys and fixed-width numbers stay Spark expressions; what has no expression is an Arrow UDF."""

from __future__ import annotations

import struct
from decimal import Context, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.column import Column

_WIDE = Context(prec=38)


def hex_lower(b: Column) -> Column:
    return F.lower(F.hex(b))


def without_salt(key: Column, salt: int) -> Column:
    """The key after its salt bytes; null if nothing is left."""
    return F.when(F.length(key) > salt, F.substr(key, F.lit(salt + 1)))


def big_endian(n: Column, size: int) -> Column:
    """A whole number of 0 or more in `size` bytes."""
    return F.unhex(F.right(F.concat(F.lit("0" * 16), F.hex(n.cast("long"))), F.lit(2 * size)))


def _unsigned(b: Column, size: int) -> Column:
    checked = F.when((F.length(b) != size) & b.isNotNull(), F.raise_error(F.lit(f"expected {size} bytes"))).otherwise(b)
    return F.conv(F.hex(checked), 16, 10).cast("decimal(20,0)")


def unsigned(b: Column, size: int) -> Column:
    """A big-endian number without sign; another length fails."""
    return _unsigned(b, size).cast("long")


def signed(b: Column, size: int) -> Column:
    """A big-endian number whose sign bit is flipped, so that bytes sort as numbers; another length fails."""
    return (_unsigned(b, size) - F.lit(Decimal(1 << (8 * size - 1)))).cast("long")


def millis(b: Column, size: int = 8) -> Column:
    """Milliseconds of a date, time (8 bytes) or timestamp (12 bytes, of which 4 hold nanoseconds)."""
    checked = F.when((F.length(b) != size) & b.isNotNull(), F.raise_error(F.lit(f"expected {size} bytes"))).otherwise(b)
    return signed(F.substring(checked, 1, 8), 8)


def confluent_frame(schema_id: Column, body: Column) -> Column:
    """A zero byte, the schema's id in four bytes, the body."""
    return F.concat(F.unhex(F.lit("00")), big_endian(schema_id, 4), body)


def _sortable(b: Column, size: int, to: str) -> Column:
    """A floating-point number of sortable bytes: its bits plus one, the sign bit flipped, all bits of a negative one."""

    @F.arrow_udf(to)
    def run(values: pa.Array) -> pa.Array:
        raw = values.drop_null().to_pylist()
        if any(len(v) != size for v in raw):
            raise ValueError(f"expected {size} bytes")
        n = np.frombuffer(b"".join(raw), f">u{size}").astype(f"u{size}") - np.array(1, f"u{size}")
        top = np.array(1 << (8 * size - 1), f"u{size}")
        numbers = np.where(n & top, n ^ top, ~n).view(f"f{size}")
        out = np.zeros(len(values), f"f{size}")
        known = values.is_valid().to_numpy(zero_copy_only=False)
        out[known] = numbers
        return pa.array(out, mask=~known)

    return run(b)


def double_of(b: Column) -> Column:
    """A double of 8 sortable bytes; another length fails."""
    return _sortable(b, 8, "double")


def float_of(b: Column) -> Column:
    """A float of 4 sortable bytes; another length fails."""
    return _sortable(b, 4, "float")


def _decimal(b: bytes) -> Decimal:
    """Digits to the base 100 after an exponent byte; of a negative number each byte runs the other way, with an end byte.

    A positive number's exponent byte is its exponent + 65 with the high bit set, its digits are stored plus 1; a
    negative one's is 62 - exponent, its digits are 101 minus the digit. Zero is the exponent byte 0x80 alone.
    """
    if b == b"\x80":
        return Decimal(0)
    positive = bool(b) and b[0] >= 0x80
    digits = [d - 1 for d in b[1:]] if positive else [101 - d for d in (b[1:-1] if b[-1:] == b"\x66" else b[1:])]
    if not digits or not all(0 <= d < 100 for d in digits):
        raise ValueError(f"not a decimal: {b.hex()}")
    exponent = (b[0] & 0x7F) - 65 if positive else 62 - b[0]
    whole = "".join(f"{d:02d}" for d in digits)
    return Decimal(f"{'' if positive else '-'}{whole}E{2 * (exponent - len(digits) + 1)}")


def decimal_of(b: Column, scale: int = 18) -> Column:
    """decimal(38, scale) of a variable-length decimal; one that does not fit exactly fails."""

    @F.pandas_udf(f"decimal(38,{scale})")
    def run(values: pd.Series) -> pd.Series:
        def one(v):
            if v is None:
                return None
            exact = _decimal(bytes(v))
            fitted = _WIDE.quantize(exact, Decimal(1).scaleb(-scale))
            if fitted != exact:
                raise ValueError(f"{exact} has more than {scale} decimal places")
            return fitted

        return pd.Series([one(v) for v in values], dtype=object)

    return run(b)


def decimal_bytes(n: Column) -> Column:
    """The variable-length form of a decimal column, without trailing zero digits."""

    @F.pandas_udf("binary")
    def run(values: pd.Series) -> pd.Series:
        def one(v):
            if v is None:
                return None
            sign, digits, places = v.as_tuple()
            text = "".join(map(str, digits)).lstrip("0")
            if not text:
                return b"\x80"
            if places % 2:
                text, places = text + "0", places - 1
            text = text.zfill(len(text) + len(text) % 2)
            exponent = places // 2 + len(text) // 2 - 1
            text = text.rstrip("0")
            pairs = [int(text[k : k + 2].ljust(2, "0")) for k in range(0, len(text), 2)]
            if sign:
                return bytes([62 - exponent, *(101 - d for d in pairs), 0x66])
            return bytes([(exponent + 65) | 0x80, *(d + 1 for d in pairs)])

        return pd.Series([one(v) for v in values], dtype=object)

    return run(n)


def _texts(b: bytes) -> list[str | None]:
    """Elements of an array of texts by its trailer: place of the offsets (4 bytes), count (4, negative with wide offsets), version (1)."""
    if not b:
        return []
    if len(b) < 9:
        raise ValueError("an array ends with 9 bytes")
    at, count = struct.unpack(">ii", b[-9:-1])
    wide, count = count < 0, abs(count)
    size = 4 if wide else 2
    if not 0 <= at <= at + size * count <= len(b) - 9:
        raise ValueError("the offsets of an array lie outside of it")
    starts = struct.unpack(f">{count}{'i' if wide else 'h'}", b[at : at + size * count])
    starts = [abs(s if wide else s + 0x7FFF) for s in starts]
    # Each element ends with a zero byte, two more close the array.
    ends = [*(s - 1 for s in starts[1:]), at - 3][:count]
    return [b[s:e].decode() if e > s and b[s] else None for s, e in zip(starts, ends, strict=True)]


def texts_of(b: Column) -> Column:
    """array<string> of an array of texts; null elements (a zero byte and how many there are in a row) stay null, which empty texts are, broken offsets fail."""

    @F.pandas_udf("array<string>")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else _texts(bytes(v)) for v in values], dtype=object)

    return run(b)


#: A text of a key up to the zero byte that ends it, in characters that stand for a byte each; what is taken is never given back.
_TEXT = r"(?:[^\x00\xFF]++|\xFF\x00?+)*+"
_BYTES = "ISO-8859-1"


def key_parts(key: Column, kinds: list[tuple[str, int]], salt: int = 0) -> Column:
    """array<binary>: the columns (kind, width) of a row key, unescaped; null from the first that can't be cut off.

    Text columns (width 0) end at a zero byte that no 0xFF of theirs precedes, the last one at the end of the key; in
    them FF00 stands for a zero byte and FFFF for 0xFF. What precedes the first text lies at fixed places; the rest is
    found by patterns over the key with a character for each byte. A null key has null columns.
    """
    text, before, at, out = F.decode(key, _BYTES), f"(?s)^.{{{salt}}}", salt, []
    # No match gives an empty list, of which element 1 is null; each pattern runs once a row, as nothing here is conditional.
    found = lambda body: F.try_element_at(F.regexp_extract_all(text, F.lit(f"{before}({body})"), F.lit(1)), F.lit(1))
    for k, (_, width) in enumerate(kinds):
        if width and at is not None:
            out.append(F.when(F.length(key) >= at + width, F.substring(key, at + 1, width)))
            at += width
        elif width:
            out.append(F.encode(found(f".{{{width}}}"), _BYTES))
        else:
            escaped = found(".*" if k == len(kinds) - 1 else _TEXT + r"(?=\x00)")
            out.append(F.encode(F.regexp_replace(escaped, r"\xFF([\x00\xFF])", "$1"), _BYTES))
            at = None
        before += f".{{{width}}}" if width else _TEXT + r"\x00"
    return F.array(*out)
