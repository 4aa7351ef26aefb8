"""Structured data (JSON-LD) as sentences, in column expressions over VARIANT values.

Scripts are parsed once; a script that is no JSON, or names a key twice, gives nothing. Blocks are a script's object, its list's objects or those of its
``@graph``. Parts of an organization (its sub-organizations and departments) speak after it, LEVELS deep. Numbers are told as JSON has them, without
trailing zeros, and truth values in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.functions.text import let, strip

LEVELS, OFFERS = 3, 5
EVENTS = ["Event", "MusicEvent", "DanceEvent", "FoodEvent"]

_EMPTY = "array<string>"


def _at(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f'$["{key}"]', "variant")


def _told(v: Column) -> Column:
    """A value as text, objects and lists as JSON; null for none."""
    return F.try_variant_get(v, "$", "string")


def _is_text(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def _counts(v: Column) -> Column:
    """Whether a value is told: no empty text, zero or false."""
    return F.when(_is_text(v), _told(v) != "").otherwise(~F.coalesce(_told(v), F.lit("")).isin("", "0", "false"))


def _say(b: Column, key: str) -> Column:
    """A key's text, empty if there is none."""
    return F.coalesce(_told(_at(b, key)), F.lit(""))


def _listed(v: Column) -> Column:
    """A list's values, or the value alone."""
    nothing = F.array().cast("array<variant>")
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(v.isNotNull(), F.array(v)), nothing)


def _objects(values: Column) -> Column:
    return F.filter(values, lambda x: F.try_variant_get(x, "$", "map<string,variant>").isNotNull())


def blocks(scripts: Column) -> Column:
    """array<variant>: the objects of JSON-LD scripts, in order; scripts is array<string>."""

    def of(v: Column) -> Column:
        graph = F.try_variant_get(v, '$["@graph"]', "array<variant>")
        return _objects(F.coalesce(graph, _listed(v)))

    return F.flatten(F.transform(F.coalesce(scripts, F.array().cast(_EMPTY)), lambda raw: let(F.try_parse_json(raw), of)))


def kind(b: Column) -> Column:
    """A block's type: a text, ? if it has none, else the JSON that stands there."""
    t = _at(b, "@type")
    return F.when(t.isNull() | (F.schema_of_variant(t) == "VOID"), F.when(t.isNull(), "?").otherwise("null")).when(_is_text(t), _told(t)).otherwise(F.to_json(t))


def _hours(v: Column) -> Column:
    many = F.try_variant_get(v, "$", "array<variant>")
    told = _told(v)
    one = F.when(_counts(v), F.concat(F.lit("Opening Hours: "), told))
    return F.when(many.isNull(), one).when(F.size(many) > 0, F.array_join(F.transform(many, lambda x: F.coalesce(_told(x), F.lit("None"))), " | "))


def _spec(s: Column) -> Column:
    days, opens = F.filter(F.transform(_listed(_at(s, "dayOfWeek")), lambda d: _told(d)), lambda d: d.isNotNull() & (d != "")), _say(s, "opens")
    return F.when((F.size(days) > 0) & (opens != ""), F.concat(F.array_join(days, ", "), F.lit(": "), opens, F.lit("-"), _say(s, "closes")))


def _offer(o: Column) -> Column:
    name, what, price = _say(o, "name"), _say(o, "description"), _say(o, "price")
    return F.when((name != "") | (what != ""), strip(F.concat(name, F.lit(": "), what, F.lit(" "), F.when(_counts(_at(o, "price")), F.concat(F.lit("$"), price)).otherwise(""))))


def _own(b: Column) -> Column:
    """What a block itself says, nulls between."""
    named = [F.when(_is_text(_at(b, k)) & (F.length(_say(b, k)) > 5), _say(b, k)) for k in ("name", "description")]
    offers = F.flatten(F.transform(F.array(*[_at(b, k) for k in ("makesOffer", "hasOfferCatalog", "offers")]), lambda v: F.slice(_objects(_listed(v)), 1, OFFERS)))
    event = F.when(_is_text(_at(b, "@type")) & _say(b, "@type").isin(EVENTS), strip(F.concat(F.lit("Event: "), F.concat_ws(" ", _say(b, "name"), _say(b, "startDate"), _say(b, "description")))))
    menu = let(_at(b, "hasMenu"), lambda m: F.when(F.try_variant_get(m, "$", "map<string,variant>").isNotNull() & ((_say(m, "name") != "") | (_say(m, "description") != "")), strip(F.concat(F.lit("Menu: "), _say(m, "name"), F.lit(" "), _say(m, "description")))))
    return F.concat(
        F.array(*named, let(_at(b, "openingHours"), _hours)), F.transform(_objects(_listed(_at(b, "openingHoursSpecification"))), lambda s: _spec(s)), F.transform(offers, lambda o: _offer(o)), F.array(event, menu))


def _said(b: Column, levels: int) -> Column:
    if not levels:
        return _own(b)
    parts = F.flatten(F.transform(F.array(_at(b, "subOrganization"), _at(b, "department")), lambda v: _objects(_listed(v))))
    return F.concat(_own(b), F.flatten(F.transform(parts, lambda p: _said(p, levels - 1))))


def texts(blocks_: Column, levels: int = LEVELS) -> Column:
    """array<string>: what blocks say, in order: names, hours, offers, events, menus, then their parts."""
    return F.filter(F.flatten(F.transform(blocks_, lambda b: _said(b, levels))), lambda t: t.isNotNull())
