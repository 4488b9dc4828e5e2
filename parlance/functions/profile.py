"""User profile: name and area from a profile cell."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parlance.functions.literal import as_map, field, is_string, read_value
from parlance.functions.text import bind, is_blank, strip


def parse_profile(user_data: Column, clean: bool = True) -> Column:
    """Profile text -> ``struct<nombre, ciudad>``, blank when it cannot be read.

    ``ciudad`` falls back to ``gerencia`` only when the key is absent. ``clean``
    strips both and cuts the area at an opening parenthesis.
    """
    text = F.when(~is_blank(user_data), strip(user_data))
    value = read_value(text)
    members = bind(value, lambda v: F.when(as_map(v).isNotNull(), F.coalesce(field(v, "M"), v)))

    def member(profile: Column, name: str) -> Column:
        return F.coalesce(field(profile, name, "S"), field(profile, name))

    found = bind(members, lambda m: F.struct(
        member(m, "nombre").alias("name"),
        F.coalesce(member(m, "ciudad"), member(m, "gerencia")).alias("area"),
    ))

    def columns(v: Column) -> Column:
        # A profile with anything but text in it is not used at all.
        usable = (v["name"].isNull() | is_string(v["name"])) & (v["area"].isNull() | is_string(v["area"]))

        def as_text(part: Column) -> Column:
            return F.coalesce(F.when(usable, F.try_variant_get(part, "$", "string")), F.lit(""))

        name_text, area_text = as_text(v["name"]), as_text(v["area"])
        if clean:
            name_text, area_text = strip(name_text), cut_parenthesis(strip(area_text))
        return F.struct(name_text.alias("nombre"), area_text.alias("ciudad"))

    return bind(found, columns)


def cut_parenthesis(area: Column) -> Column:
    """Keep what comes before "(", when both parentheses occur."""
    both = F.contains(area, F.lit("(")) & F.contains(area, F.lit(")"))
    return F.when(both, strip(F.split_part(area, F.lit("("), F.lit(1)))).otherwise(area)
