"""Columns computed for showing an answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commitlens.functions.lists import pipe_split

# Classes of a badge's background and text colour per language, and of any other.
LANGUAGE_COLORS = {
    "javascript": ("bg-[#F7DF1E]", "text-black"),
    "typescript": ("bg-[#3178C6]", "text-white"),
    "python": ("bg-[#3776AB]", "text-white"),
    "java": ("bg-[#007396]", "text-white"),
    "ruby": ("bg-[#CC342D]", "text-white"),
    "php": ("bg-[#777BB4]", "text-white"),
    "go": ("bg-[#00ADD8]", "text-white"),
    "rust": ("bg-[#DEA584]", "text-black"),
    "c": ("bg-[#A8B9CC]", "text-black"),
    "c++": ("bg-[#00599C]", "text-white"),
    "c#": ("bg-[#239120]", "text-white"),
    "swift": ("bg-[#FA7343]", "text-white"),
    "kotlin": ("bg-[#7F52FF]", "text-white"),
    "sql": ("bg-[#4479A1]", "text-white"),
    "r": ("bg-[#276DC3]", "text-white"),
    "html": ("bg-[#E34F26]", "text-white"),
    "css": ("bg-[#1572B6]", "text-white"),
    "shell": ("bg-[#4EAA25]", "text-white"),
    "dart": ("bg-[#0175C2]", "text-white"),
    "scala": ("bg-[#DC322F]", "text-white"),
    "haskell": ("bg-[#5D4F85]", "text-white"),
    "elixir": ("bg-[#4B275F]", "text-white"),
    "clojure": ("bg-[#5881D8]", "text-white"),
    "perl": ("bg-[#39457E]", "text-white"),
}
OTHER_COLOR = ("bg-gray-100", "text-gray-800")

# Bar colour from this mean ability on.
ABILITY_BANDS = [(8, "green"), (6, "blue"), (4, "yellow")]
LOWEST_BAND = "gray"


def language_color(language: Column) -> Column:
    """(background, text) classes of a language's badge."""

    def pair(colors: tuple[str, str]) -> Column:
        background, text = colors
        return F.struct(F.lit(background).alias("background"), F.lit(text).alias("text"))

    known = F.create_map(*[x for name, colors in LANGUAGE_COLORS.items() for x in (F.lit(name), pair(colors))])
    return F.coalesce(F.try_element_at(known, F.trim(F.lower(language))), pair(OTHER_COLOR))


def mean_score(total: Column, rows: Column) -> Column:
    """Unweighted mean over a person's rows to one decimal, from their sum; 0 for none."""
    # Eight decimals first: a half must not fall on either side by the last bit of a sum.
    mean = F.round(F.round(F.try_divide(F.coalesce(total, F.lit(0.0)), rows), 8).cast("decimal(20,8)"), 1)
    return F.when(rows > 0, mean).otherwise(0).cast("double")


def ability_band(score: Column) -> Column:
    (top, color), *rest = ABILITY_BANDS
    band = F.when(score >= top, color)
    for low, color in rest:
        band = band.when(score >= low, color)
    return band.otherwise(LOWEST_BAND)


def bar_width(score: Column) -> Column:
    """Per cent of a ten-point bar."""
    return score / 10 * 100


def emails(joined: Column) -> Column:
    return pipe_split(joined)


def sorted_languages(joined: Column) -> Column:
    return F.array_sort(pipe_split(joined))


def repo_link(repo: Column) -> Column:
    return F.concat(F.lit("https://github.com/"), repo)
