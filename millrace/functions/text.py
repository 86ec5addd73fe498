"""Cleaning and formatting of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.regex import strip, sub

# --- fixed values: formats of targets, samples, prompts and vocabulary texts ----------------------
TITLE, STEP, STEP_END = "Title: ", "Step ", ": "
SAMPLE = ("Ingredients: ", "\nRecipe: ")
PROMPT, PROMPT_END, PROMPT_TITLE_END = "Ingredients: ", "\nRecipe:", "\nRecipe:\nTitle:"
TITLE_SCAFFOLD = "title_then_steps"
TAGS = {"title": "<TITLE> ", "ingredients": "<ING> ", "recipe": "<REC> "}
VISIBLE_BLANK = "Ġ"


def clean(col: Column) -> Column:
    """Drop URLs and leading bullets, fold whitespace. Null becomes ``""``.

    The text is stripped first only: a URL removed from the front leaves one blank there.
    """
    col = strip(F.coalesce(col, F.lit("")))
    col = sub(col, r"https?://\S+", "")
    col = sub(col, r"(?m)^[•\-*]\s*", "")
    return sub(col, r"\s+", " ")


def collapse_commas(col: Column) -> Column:
    """One ", " between parts, however many commas stood there; none at the ends."""
    col = sub(col, r"(?:\s*,)++\s*", ", ")
    return sub(col, r"^[ ,]+|[ ,]+\z", "")


def format_target(title: Column, steps: Column) -> Column:
    """``Title: t`` and ``Step i: s`` lines. A blank step is left out but keeps its number."""
    title = strip(F.coalesce(title, F.lit("")))
    cleaned = F.transform(
        F.coalesce(steps, F.array().cast("array<string>")),
        lambda s, i: F.struct(i.alias("i"), clean(s).alias("s")),
    )
    lines = F.transform(
        F.filter(cleaned, lambda p: p["s"] != ""),
        lambda p: F.concat(F.lit(STEP), (p["i"] + 1).cast("string"), F.lit(STEP_END), p["s"]),
    )
    head = F.when(title != "", F.concat(F.lit(TITLE), title))
    return F.array_join(F.concat(F.array_compact(F.array(head)), lines), "\n")


def title_line(target: Column) -> Column:
    """First line of a target."""
    return strip(F.substring_index(F.coalesce(target, F.lit("")), "\n", 1))


def sample_text(ingredients: Column, recipe: Column) -> Column:
    """The text that is encoded for one processed row."""
    return F.concat(
        F.lit(SAMPLE[0]),
        F.coalesce(ingredients, F.lit("")),
        F.lit(SAMPLE[1]),
        F.coalesce(recipe, F.lit("")),
    )


def prompt(ingredients: Column, scaffold: Column | str = "basic") -> Column:
    """Prompt of one row; a scaffold that is not known means the basic one."""
    if isinstance(scaffold, str):
        scaffold = F.lit(scaffold)
    end = F.when(scaffold == TITLE_SCAFFOLD, F.lit(PROMPT_TITLE_END)).otherwise(F.lit(PROMPT_END))
    return F.concat(F.lit(PROMPT), ingredients, end)


def readable(col: Column, fold: bool = True) -> Column:
    """Turn the visible blank of byte-level pieces into a blank; ``fold`` runs of blanks."""
    col = F.replace(col, F.lit(VISIBLE_BLANK), F.lit(" "))
    return strip(F.regexp_replace(col, " {2,}", " ") if fold else col)


def corpus_text(
    ingredients: Column,
    recipe: Column,
    fields: tuple[str, ...] = ("ingredients", "recipe", "title"),
) -> Column:
    """Tagged text of one row for building a vocabulary; ``""`` if no part is there."""
    values = {"title": title_line(recipe), "ingredients": ingredients, "recipe": recipe}
    parts = [
        F.when(value != "", F.concat(F.lit(TAGS[name]), value))
        for name, value in values.items()
        if name in fields
    ]
    return F.concat_ws(" ", *parts)
