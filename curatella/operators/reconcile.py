"""Reconciling incoming rows with a table: each operator returns frames, tagged with an action where it
decides one, and has no side effects. `First wins` always means an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curatella.functions.blank import str_blank


def keep_one(df: DataFrame, keys: list[str], order: list[Column | str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key in order. Null keys are a key of their own, as in SQL grouping.

    The order should be total; what it leaves tied is decided by the row's content.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    total = F.struct(*order, *(F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")))
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    pick = (F.max_by if last else F.min_by)(whole, total).alias("_row")
    return df.groupBy(*keys).agg(pick).select("_row.*")


def insert_new(incoming: DataFrame, current: DataFrame, keys: dict[str, Column], current_keys: dict[str, Column], order: list[str]) -> DataFrame:
    """Incoming rows whose keys aren't in current, one per key, the first in order.

    keys and current_keys: name -> expression, so that both sides are normalised before they are
    compared and before duplicates are found. Rows with a null key match nothing and are all kept.
    """
    tagged = incoming.withColumns({f"_k_{n}": e for n, e in keys.items()})
    names = [f"_k_{n}" for n in keys]
    have = current.select(*(current_keys[n].alias(f"_k_{n}") for n in keys)).distinct()
    fresh = tagged.join(have, names, "left_anti")
    known = None
    for n in names:
        known = F.col(n).isNotNull() if known is None else known & F.col(n).isNotNull()
    return keep_one(fresh.where(known), names, order).unionByName(fresh.where(~known)).drop(*names)


def patch_blank(current: DataFrame, incoming: DataFrame, key: str, fields: list[str], differing: tuple[str, ...] = (), order: list[str] | None = None) -> DataFrame:
    """current with blank fields filled from incoming by key, and _patched, the names of those that changed.

    differing: fields that are overwritten wherever incoming has another, not blank value. Of several
    incoming rows of a key the first in order counts. Nothing is deleted; a null key patches nothing.
    """
    order = order or [c for c in incoming.columns if c != key]
    new = keep_one(incoming.where(F.col(key).isNotNull()), [key], order).select(key, *(F.col(f).alias(f"_new_{f}") for f in [*fields, *differing]))
    both = current.join(new, key, "left")
    changes = {f: str_blank(F.col(f)) & ~str_blank(F.col(f"_new_{f}")) for f in fields} | {f: ~str_blank(F.col(f"_new_{f}")) & ~F.col(f).eqNullSafe(F.col(f"_new_{f}")) for f in differing}
    out = both.withColumn("_patched", F.concat_ws(",", *(F.when(c, F.lit(f)) for f, c in changes.items())))
    return out.select(*(F.when(changes[c], F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in current.columns), "_patched")


def sync(current: DataFrame, incoming: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """(key, action): insert, update, same, or missing (kept, only reported). One row per key of either side.

    Both sides must hold a key once; a null key of incoming is an insert, of current missing.
    """
    a = incoming.select(F.col(key).alias("_ka"), F.lit(True).alias("_ina"), *(F.col(c).alias(f"_a_{c}") for c in compared))
    b = current.select(F.col(key).alias("_kb"), F.lit(True).alias("_inb"), *(F.col(c).alias(f"_b_{c}") for c in compared))
    both = a.join(b, F.col("_ka") == F.col("_kb"), "full")
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))
    action = F.when(F.col("_inb").isNull(), "insert").when(F.col("_ina").isNull(), "missing").when(same, "same").otherwise("update")
    return both.select(F.coalesce("_ka", "_kb").alias(key), action.alias("action"))


def key_map(sources: list[DataFrame], keys: list[str], value: str, order: list[str], last: bool = False) -> DataFrame:
    """keys -> value over sources in order of precedence: a later source supplements, never overrides."""
    out = None
    for rank, s in enumerate(sources):
        own = keep_one(s.select(*keys, value, *order), keys, order, last).withColumn("_rank", F.lit(rank))
        out = own if out is None else out.unionByName(own)
    return keep_one(out, keys, ["_rank", *order]).select(*keys, value)


def route_links(incoming: DataFrame, current: DataFrame, pair: list[str], target: str, id_: str, order: list[str]) -> DataFrame:
    """incoming with action: skip_id (its id is known), skip_pair (the pair is linked to a target already),
    patch (the pair is known without a target, which incoming has), duplicate (a pair that came earlier in
    this batch) or insert."""
    ids = current.select(F.col(id_).alias("_id")).distinct()
    pairs = current.groupBy(*pair).agg(F.max(F.col(target).isNotNull()).alias("_linked"))
    tagged = incoming.join(ids, F.col(id_) == F.col("_id"), "left").join(pairs, pair, "left")
    rank = F.row_number().over(Window.partitionBy(*pair, F.col("_id").isNull()).orderBy(*order))
    action = F.when(F.col("_id").isNotNull(), "skip_id").when(rank > 1, "duplicate").when(F.col("_linked"), "skip_pair").when(F.col("_linked").isNotNull() & F.col(target).isNotNull(), "patch").when(F.col("_linked").isNotNull(), "skip_pair").otherwise("insert")
    return tagged.withColumn("action", action).drop("_id", "_linked")


def resolve(df: DataFrame, lookups: list[tuple[Column, DataFrame, str, str]], out: str, reason: str) -> DataFrame:
    """df with ``out``, the value of the first lookup that knows the row's key, and _reject, ``reason``
    where none does. lookups: (key expression, table, key column, value column), one value per key."""
    found = []
    for i, (expr, t, k, v) in enumerate(lookups):
        df = df.join(t.select(F.col(k).alias(f"_k{i}"), F.col(v).alias(f"_v{i}")), expr == F.col(f"_k{i}"), "left")
        found.append(F.col(f"_v{i}"))
    drop = [f"_{x}{i}" for i in range(len(lookups)) for x in "kv"]
    return df.withColumn(out, F.coalesce(*found)).withColumn("_reject", F.when(F.col(out).isNull(), reason)).drop(*drop)


def unlinked(sources: list[tuple[DataFrame, DataFrame | None]], key: str, columns: list[str]) -> DataFrame:
    """Rows of the sources whose key isn't in the source's own linked set, one per key; earlier sources win."""
    out = None
    for rank, (s, linked) in enumerate(sources):
        own = s if linked is None else s.join(linked.select(key).distinct(), key, "left_anti")
        own = own.select(*columns).withColumn("source_rank", F.lit(rank))
        out = own if out is None else out.unionByName(own)
    return keep_one(out, [key], ["source_rank"])


def delete_set(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Ids of rows to delete: those with a null key, and all but the lowest id of each key.

    Only the duplicates meet the window's row: the lowest ids are aggregated with map-side combine.
    """
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row_id).alias("_first"))
    return df.join(first, key, "left").where(F.col("_first").isNull() | (F.col(row_id) > F.col("_first"))).select(row_id)


def cascade(parents: DataFrame, key: str, children: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """Rows of each child table whose foreign key is among the parents to be deleted."""
    gone = parents.select(F.col(key).alias("_gone")).where(F.col("_gone").isNotNull()).distinct()
    return {name: t.join(gone, t[fk] == F.col("_gone"), "left_semi") for name, (t, fk) in children.items()}


def repair_fk(df: DataFrame, fk: str, valid: DataFrame, valid_key: str, alternative: DataFrame, alt_key: str, alt_value: str) -> DataFrame:
    """df with action and fixed_key: keep (the key is valid or null), fix (it is another table's id, whose
    value is valid here), or delete (neither)."""
    ok = valid.select(F.col(valid_key).alias("_ok")).distinct()
    alt = alternative.select(F.col(alt_key).alias("_ak"), F.col(alt_value).alias("_av")).where(F.col("_av").isNotNull()).groupBy("_ak").agg(F.min("_av").alias("_av"))
    both = df.join(ok, F.col(fk) == F.col("_ok"), "left").join(alt, F.col(fk) == F.col("_ak"), "left")
    action = F.when(F.col(fk).isNull() | F.col("_ok").isNotNull(), "keep").when(F.col("_av").isNotNull(), "fix").otherwise("delete")
    return both.withColumn("action", action).withColumn("fixed_key", F.when(F.col("action") == "fix", F.col("_av")).otherwise(F.col(fk))).drop("_ok", "_ak", "_av")


def people(df: DataFrame, names: str, affiliations: str, id_: str) -> DataFrame:
    """(name, affiliation, id_): one row per name of the `;` lists, a lacking affiliation taken from the
    last one given; of one name the row with an affiliation wins, of equals the smallest id."""
    n, a = F.filter(F.transform(F.split(names, ";"), lambda x: F.trim(x)), lambda x: x != ""), F.transform(F.split(F.coalesce(F.col(affiliations), F.lit("")), ";"), lambda x: F.trim(x))
    each = df.where(F.col(names).isNotNull()).select(F.col(id_), F.posexplode(n).alias("_p", "name"), a.alias("_a"))
    own = F.coalesce(F.get("_a", F.col("_p")), F.element_at("_a", -1))
    each = each.select(id_, "name", F.when(own != "", own).alias("affiliation"))
    return keep_one(each, ["name"], [F.col("affiliation").isNull(), F.col(id_)]).select("name", "affiliation", id_)


def fill_from(df: DataFrame, field: str, key: str, sources: list[DataFrame]) -> DataFrame:
    """df with blank ``field`` filled from sources (key, field) in order of precedence, and _filled_from
    (0 its own, 1 the first source, ...; null where blank still). Sources hold a key once."""
    values, known = [F.when(~str_blank(F.col(field)), F.col(field))], []
    for i, s in enumerate(sources, 1):
        df = df.join(s.select(F.col(key), F.col(field).alias(f"_v{i}")), key, "left")
        values.append(F.when(~str_blank(F.col(f"_v{i}")), F.col(f"_v{i}")))
    for i, v in enumerate(values):
        known.append(F.when(v.isNotNull(), F.lit(i)))
    return df.withColumn("_filled_from", F.coalesce(*known)).withColumn(field, F.coalesce(*values)).drop(*(f"_v{i}" for i in range(1, len(sources) + 1)))


def match_by(current: DataFrame, incoming: DataFrame, keys: list[str], fields: list[str], order: list[str], pair: bool = False) -> DataFrame:
    """current with ``fields`` taken from the incoming row of equal keys, and action: `update` where one
    differs, else `same`, `none` where there is no such row; incoming rows that match nothing follow with
    `insert`.

    pair: all keys must be equal; else the first key that both sides have. All current rows that match are
    updated. Of several incoming rows of one key the first in order counts. A null key matches nothing.
    """
    by = [keys] if pair else [[k] for k in keys]
    out, left = current, incoming
    drop, values, hits = [], [], []
    for i, own in enumerate(by):
        known = F.lit(True)
        for k in own:
            known = known & F.col(k).isNotNull()
        first = keep_one(incoming.where(known), own, order).select(*(F.col(k).alias(f"_k{i}_{k}") for k in own), F.struct(*fields).alias(f"_v{i}"))
        on = F.lit(True)
        for k in own:
            on = on & (F.col(k) == F.col(f"_k{i}_{k}"))
        out = out.join(first, on, "left")
        left = left.join(current.select(*own).distinct(), own, "left_anti")
        drop += [f"_v{i}", *(f"_k{i}_{k}" for k in own)]
        values.append(F.col(f"_v{i}"))
        hits.append(F.col(f"_v{i}").isNotNull())
    new = F.coalesce(*values)
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f).eqNullSafe(new[f])
    action = F.when(new.isNull(), "none").when(differs, "update").otherwise("same")
    done = out.withColumn("action", action).withColumns({f: F.when(new.isNull(), F.col(f)).otherwise(new[f]) for f in fields}).drop(*drop)
    return done.unionByName(left.withColumn("action", F.lit("insert")).select(*(c for c in done.columns if c in left.columns or c == "action")), allowMissingColumns=True)
