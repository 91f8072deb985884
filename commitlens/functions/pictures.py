"""What picture bytes say about themselves, read with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commitlens.functions.binding import let

# How the formats begin, where PNG keeps its colour type and what channels it means.
PNG, GIF, BMP, JPEG = "89504E470D0A1A0A0000000D49484452", "47494638", "424D", "FFD8FF"
PNG_CHANNELS = {0: 1, 2: 3, 3: 3, 4: 2, 6: 4}
# JPEG segments looked through before the walk is made as long as the picture is.
_USUAL_SEGMENTS = 64
SIZE = "struct<format: string, width: int, height: int, channels: int>"


def _hex(c: Column, at: Column | int, n: int) -> Column:
    return F.hex(F.substr(c, (F.lit(at) if isinstance(at, int) else at) + 1, F.lit(n)))


def _number(c: Column, at: Column | int, n: int, little: bool = False) -> Column:
    """The unsigned number of ``n`` bytes at a place counted from 0; null behind the end."""
    digits = _hex(c, at, n)
    if little:
        digits = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(n))])
    return F.when(F.length(digits) == 2 * n, F.conv(digits, 16, 10).cast("bigint"))


def _frame(c: Column, most: Column) -> Column:
    """Where a JPEG's frame header stands: a walk from segment to segment, each of which says its length.

    The walk ends at the first frame header, and with -1 at the picture's data, at what is no segment, or behind the end.
    """

    def step(at: Column, _: Column) -> Column:
        head = F.when(at >= 0, _hex(c, at, 4))
        return F.when(at < 0, at).otherwise(let(head, lambda h: beyond(at, h)))

    def beyond(at: Column, head: Column) -> Column:
        """Where the segment at ``at`` ends, which begins with the hex digits ``head``."""
        number = F.when(F.length(head) >= 4, F.conv(F.substring(head, 3, 2), 16, 10).cast("int"))
        return let(number, lambda marker: after(at, head, marker))

    def after(at: Column, head: Column, marker: Column) -> Column:
        length = F.when(F.length(head) == 8, F.conv(F.substring(head, 5, 4), 16, 10).cast("int"))
        is_segment = head.startswith("FF") & marker.isNotNull()
        frame = marker.between(0xC0, 0xCF) & ~marker.isin(0xC4, 0xC8, 0xCC)
        further = (
            F.when(~is_segment | marker.isNull(), F.lit(-1))
            # Fill bytes, and markers that stand alone.
            .when(marker == 0xFF, at + 1)
            .when((marker == 0x01) | marker.between(0xD0, 0xD8), at + 2)
            .when(marker.isin(0xD9, 0xDA) | length.isNull() | (length < 2), F.lit(-1))
            .otherwise((at + 2 + length).cast("int"))
        )
        return F.when(F.coalesce(is_segment & frame, F.lit(False)), at).otherwise(F.coalesce(further, F.lit(-1)))

    return F.aggregate(F.sequence(F.lit(1), most), F.lit(2), step)


def _shape(kind: str, width: Column, height: Column, channels: Column) -> Column:
    def within(s: Column) -> Column:
        fits = (s["width"] > 0) & (s["height"] > 0) & (s["channels"] > 0) & (s["width"] < 1 << 31) & (s["height"] < 1 << 31)
        return F.when(fits, F.struct(F.lit(kind).alias("format"), *[s[n].cast("int").alias(n) for n in ("width", "height", "channels")]))

    return let(F.struct(width.alias("width"), height.alias("height"), channels.alias("channels")), within)


def _jpeg(c: Column) -> Column:
    def arrived(at: Column) -> Column:
        return (at < 0) | ((_hex(c, at, 1) == "FF") & _hex(c, at + 1, 1).rlike("^C[0-35-79-BD-F]$"))

    # A segment has four bytes at least, a fill byte is one.
    whole = _frame(c, F.greatest(F.octet_length(c), F.lit(1)))
    at = let(_frame(c, F.lit(_USUAL_SEGMENTS)), lambda usual: F.when(F.coalesce(arrived(usual), F.lit(False)), usual).otherwise(whole))
    return let(at, lambda x: F.when(x >= 0, _shape("jpeg", _number(c, x + 7, 2), _number(c, x + 5, 2), _number(c, x + 9, 1))))


def picture_size(c: Column) -> Column:
    """Format, width, height and channels of PNG, GIF, BMP and JPEG bytes; null for anything else and for broken headers.

    Headers only: no pixel is decoded. A GIF and a PNG with a palette count as three channels.
    """
    start = F.hex(F.substring(c, 1, 16))
    color = _number(c, 25, 1)
    png_channels = F.lit(None).cast("int")
    for kind, n in PNG_CHANNELS.items():
        png_channels = F.when(color == kind, n).otherwise(png_channels)
    height = _number(c, 22, 4, little=True)
    # A BMP drawn from the top has a negative height.
    height = F.when(height > 1 << 31, (1 << 32) - height).otherwise(height)
    return (
        F.when(start == PNG, _shape("png", _number(c, 16, 4), _number(c, 20, 4), png_channels))
        .when(start.startswith(GIF), _shape("gif", _number(c, 6, 2, little=True), _number(c, 8, 2, little=True), F.lit(3)))
        .when(start.startswith(BMP), _shape("bmp", _number(c, 18, 4, little=True), height, F.floor(F.greatest(_number(c, 28, 2, little=True), F.lit(8)) / 8)))
        .when(start.startswith(JPEG), _jpeg(c))
    )
