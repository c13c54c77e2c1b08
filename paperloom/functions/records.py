"""Functions over whole records: flags, pruning, canonical JSON."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.values import FLAGS


def init_flags(df: DataFrame) -> DataFrame:
    """Every state flag set, absent meaning false."""
    def flag(name: str) -> Column:
        known = F.col(name) if name in df.columns else F.lit(None).cast("boolean")
        return F.coalesce(known, F.lit(False))

    return df.withColumns({f: flag(f) for f in FLAGS})


def _fields(record: Column) -> Column:
    return record.cast("map<string,variant>")


def prune_record(record: Column, *names: str) -> Column:
    """Open record without the named fields."""
    drop = [F.lit(n) for n in names]
    return F.to_variant_object(F.map_filter(_fields(record), lambda k, _: ~k.isin(*drop)))


def canonical_json(
    fields: dict[str, Column], record: Column | None = None, hidden: tuple[str, ...] = ()
) -> Column:
    """JSON text with sorted keys.

    `fields` are the typed values, absent ones left out. The fields of the open `record` are
    added, less the `hidden` ones. Where both have a field, the typed value counts, unless it
    is just the text of the record's, which then keeps its own type.
    """
    if record is None:
        ordered = [fields[n].alias(n) for n in sorted(fields)]
        return F.to_json(F.struct(*ordered))

    def changed(name: str, value: Column) -> Column:
        same = F.try_variant_get(record, f"$['{name}']", "string") == value.cast("string")
        return F.when(~F.coalesce(same, F.lit(False)), value).alias(name)

    typed = F.map_filter(
        _fields(F.to_variant_object(F.struct(*[changed(n, c) for n, c in fields.items()]))),
        lambda _, v: ~F.is_variant_null(v),
    )
    names = [F.lit(n) for n in hidden]
    rest = F.map_filter(
        F.coalesce(_fields(record), F.create_map().cast("map<string,variant>")),
        lambda k, _: ~F.map_contains_key(typed, k) & ~k.isin(*names),
    )
    merged = F.map_concat(typed, rest)
    ordered = F.transform(
        F.array_sort(F.map_keys(merged)), lambda k: F.struct(k, F.element_at(merged, k))
    )
    return F.to_json(F.map_from_entries(ordered))
