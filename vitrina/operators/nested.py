"""Nested series data: SDMX-JSON decoding and series long form.

An SDMX message is one row: its dimension lists are bounded by the number of
codes of a dimension, not by the data.  Decoding runs per series with
higher-order functions (``transform`` / ``filter`` / ``array_sort``): the
series map is exploded once, so the work spreads over all series, and code
labels are looked up inside the row, with no join or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.functions.text import _c, epoch_ms_date

TIME_DIMENSION = "TIME_PERIOD"   # fixed value: id of the observation time dimension
AREA_DIMENSION = "REF_AREA"      # fixed value: reference-area dimension
HOME_AREA = "ES"                 # fixed value: area kept when the flow supports it


def parse_sdmx(text: Column | str) -> Column:
    """JSON text of an SDMX message to its nested struct."""
    from vitrina.schemas import SDMX_MESSAGE
    return F.from_json(_c(text), SDMX_MESSAGE)


def _dim_of(dims: Column, i: Column) -> tuple[Column, Column]:
    """(id, values) of dimension ``i``; ``dim{i}`` with no values past the end (M1)."""
    inside = i < F.size(dims)
    dim = F.get(dims, i)
    dim_id = F.when(inside, dim["id"]).otherwise(F.concat(F.lit("dim"), i.cast("string")))
    values = F.when(inside, F.coalesce(dim["values"], F.array())).otherwise(F.array())
    return dim_id, values


def decode_series(msg: DataFrame, msg_col: str = "msg", keep: list[str] | None = None) -> DataFrame:
    """Explode every series of every data set and decode it.

    Output: the ``keep`` columns plus ``series_key``, ``dim_codes``,
    ``dimensions``, ``dimension_names``, ``name``, ``observations``
    (array of ``period, value`` in numeric index order), ``last_value``, ``count``.
    Series without observations are dropped (F10).
    """
    keep = keep or []
    m = F.col(msg_col)
    dims = F.coalesce(m["structure"]["dimensions"]["series"], F.array())
    time_dims = F.filter(F.coalesce(m["structure"]["dimensions"]["observation"], F.array()),
                         lambda d: d["id"] == TIME_DIMENSION)
    # the last TIME_PERIOD dimension wins, as a loop overwriting the list would
    time_values = F.transform(F.coalesce(F.try_element_at(time_dims, F.lit(-1))["values"], F.array()),
                              lambda v: F.coalesce(v["name"], v["id"]))
    s = (msg.select(*keep, dims.alias("_dims"), time_values.alias("_times"),
                    F.explode(F.coalesce(m["dataSets"], F.array())).alias("_ds"))
         .select(*keep, "_dims", "_times",
                 F.explode(F.map_entries(F.coalesce(F.col("_ds")["series"], F.create_map())))
                 .alias("_s")))
    s = s.select(*keep, "_dims", "_times", F.col("_s")["key"].alias("series_key"),
                 F.coalesce(F.col("_s")["value"]["observations"], F.create_map()).alias("_obs"))
    s = s.filter(F.size("_obs") > 0)  # F10
    d = F.col("_dims")
    parts = F.split(F.col("series_key"), ":")

    def code_at(k, i):
        _, values = _dim_of(d, i)
        idx = k.cast("int")
        return F.when(idx < F.size(values), F.get(values, idx)["id"]) \
            .otherwise(F.concat(F.lit("idx"), idx.cast("string")))

    codes = F.transform(parts, code_at)
    ids = F.transform(parts, lambda k, i: _dim_of(d, i)[0])
    s = s.withColumn("dim_codes", codes).withColumn("_ids", ids)

    def name_of(z):
        dim, code = z["d"], z["c"]
        same = F.filter(d, lambda x: x["id"] == dim["id"])
        hit = F.filter(F.coalesce(F.try_element_at(same, F.lit(1))["values"], F.array()),
                       lambda v: v["id"] == code)
        label = F.when(F.size(hit) > 0, F.try_element_at(hit, F.lit(1))["name"]).otherwise(code)
        return F.concat(dim["id"], F.lit("="), label)

    n = F.least(F.size(d), F.size(F.col("dim_codes")))
    zipped = F.arrays_zip(F.slice(d, 1, n).alias("d"), F.slice(F.col("dim_codes"), 1, n).alias("c"))
    names = F.when(n > 0, F.transform(zipped, name_of)).otherwise(F.array().cast("array<string>"))
    times = F.col("_times")
    obs = F.array_sort(F.transform(
        F.map_entries(F.col("_obs")),
        lambda e: F.struct(e["key"].cast("int").alias("idx"),
                           F.when(e["key"].cast("int") < F.size(times),
                                  F.get(times, e["key"].cast("int"))).otherwise(e["key"]).alias("period"),
                           F.try_element_at(e["value"], F.lit(1)).alias("value"))))
    obs = F.transform(obs, lambda o: F.struct(o["period"].alias("period"), o["value"].alias("value")))
    out = s.select(
        *keep, "series_key", "dim_codes",
        F.map_from_arrays(F.col("_ids"), F.col("dim_codes")).alias("dimensions"),
        names.alias("dimension_names"),
        F.array_join(names, " | ").alias("name"),
        obs.alias("observations"),
    )
    return out.withColumn("last_value", F.try_element_at("observations", F.lit(-1))["value"]) \
        .withColumn("count", F.size("observations").cast("bigint"))


def area_filter(df: DataFrame, has_es: Column | str, area: str = HOME_AREA) -> DataFrame:
    """Keep the home area when the flow has that dimension value."""
    flag = F.coalesce(_c(has_es), F.lit(False))
    return df.filter(~flag | (F.coalesce(F.try_element_at("dimensions", F.lit(AREA_DIMENSION)),
                                          F.lit("")) == area))


def label_codes(codes: DataFrame, dims: DataFrame, dim_col: str = "dim_id",
                code_col: str = "code") -> DataFrame:
    """Attach the label of every (dimension, code), falling back to the code.

    ``dims`` is the exploded code list ``(dim_id, code, name)``; it is left to
    Catalyst/AQE to broadcast (its size is the number of codes, not rows).
    """
    lab = dims.select(F.col("dim_id").alias("_d"), F.col("code").alias("_c"), F.col("name").alias("_n")) \
        .dropDuplicates(["_d", "_c"])
    j = codes.join(lab, (codes[dim_col] == lab["_d"]) & (codes[code_col] == lab["_c"]), "left")
    return j.withColumn("label", F.coalesce(F.col("_n"), F.col(code_col))).drop("_d", "_c", "_n")


def explode_dimensions(msg: DataFrame, msg_col: str = "msg", keep: list[str] | None = None) -> DataFrame:
    """Code lists of the series dimensions as rows ``(dim_pos, dim_id, code_pos, code, name)``."""
    keep = keep or []
    d = msg.select(*keep, F.posexplode(F.col(msg_col)["structure"]["dimensions"]["series"])
                   .alias("dim_pos", "_dim"))
    v = d.select(*keep, "dim_pos", F.col("_dim")["id"].alias("dim_id"),
                 F.posexplode(F.col("_dim")["values"]).alias("code_pos", "_v"))
    return v.select(*keep, "dim_pos", "dim_id", "code_pos", F.col("_v")["id"].alias("code"),
                    F.col("_v")["name"].alias("name"))


# ---------------------------------------------------------------------------
# Series long form (statistics API shape) M4, M5, W4, W5
# ---------------------------------------------------------------------------
def series_long(series: DataFrame, keep: list[str], data_col: str = "Data", tz: str = "UTC") -> DataFrame:
    """Explode nested values to rows ``(pos, fecha, periodo, anyo, valor)`` (M4)."""
    e = series.select(*keep, F.posexplode(F.col(data_col)).alias("pos", "_v"))
    return e.select(*keep, "pos", epoch_ms_date(F.col("_v")["Fecha"], tz).alias("fecha"),
                    F.col("_v")["FK_Periodo"].alias("periodo"), F.col("_v")["Anyo"].alias("anyo"),
                    F.col("_v")["Valor"].alias("valor"), F.col("_v")["Fecha"].alias("fecha_ms"))


def last_n_array(arr: Column | str, n: int) -> Column:
    """Last ``n`` elements of an array; ``n = 0`` keeps all (W4, array form)."""
    a = _c(arr)
    if n <= 0:
        return a
    size = F.size(a)
    return F.when(size == 0, a).otherwise(F.slice(a, F.greatest(-size, F.lit(-n)), n))


def last_n(long: DataFrame, key: list[str], order_col: str, n: int) -> DataFrame:
    """Last ``n`` rows per series by ``order_col`` (W4, long form); ``n = 0`` keeps all.

    ``row_number() <= n`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle: a hot series reaches the window with at most ``n``
    rows per map task.
    """
    if n <= 0:
        return long
    w = Window.partitionBy(*key).orderBy(F.col(order_col).desc())
    return long.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_n_series(long: DataFrame, series_col: str, n: int) -> DataFrame:
    """Rows of the first ``n`` series in ``series_col`` order.

    The distinct series keys are reduced to the first ``n`` (a top-k, n rows
    per task), then joined back; the kept key list is at most ``n`` rows.
    """
    keys = long.select(series_col).distinct().orderBy(series_col).limit(n)
    return long.join(F.broadcast(keys), series_col, "left_semi")


def series_values(long: DataFrame, table_col: str, table_id, series_col: str, date_col: str,
                  order_col: str, desde: str | None = None, hasta: str | None = None,
                  max_series: int = 5, max_values: int = 20) -> DataFrame:
    """Query one table's stored series (M5, D7 fixed: bounds are independent).

    Date bounds accept ``YYYY-MM-DD`` or ``YYYYMMDD`` and compare on compact text.
    """
    from vitrina.functions.text import compact_date
    t = long.filter(F.col(table_col) == F.lit(table_id))
    d = compact_date(F.col(date_col))
    if desde:
        t = t.filter(d >= desde.replace("-", ""))
    if hasta:
        t = t.filter(d <= hasta.replace("-", ""))
    t = first_n_series(t, series_col, max_series)
    return last_n(t, [series_col], order_col, max_values)


def to_json_result(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One JSON text per row (M6)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("json"))
