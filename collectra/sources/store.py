"""Sinks and stored datasets: detail parquet, JSON summaries, manifest, exports.

Every dataset lives under one root (on a cluster: the shared folder named by
``spark.checkpoint.dir``, see :mod:`collectra.session`) in one folder per job
(``job_id=<job>``).  A job's folder is written and read by itself: rewriting a
job replaces all of it, an empty result included, reading it lists no other
job, and each job keeps its own columns.

*Publishing.*  A write goes to a fresh version folder and is published last, by
creating one empty file whose name holds a number and the version; readers take
the version of the largest number.  Until then, and after a write that failed
halfway, they find the version before.  The version that was replaced stays for
readers that have begun with it, older ones go.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collectra.functions.columns import existing, q
from collectra.functions.dates import dates_to_text
from collectra.schemas import (DROP_NAME_PATTERN, ORIGIN_FOLDERS, SEARCH_TEXT_COLUMNS, VINTAGE_SECTIONS)
from collectra.session import fresh_path
from collectra.sources import indexes


def job_path(root: str, folder: str, job_id: str) -> str:
    return f"{root}/{folder}/job_id={job_id}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _get(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[str]:
    """Published versions of a dataset folder, oldest first (names of their folders)."""
    fs, p = _fs(spark, f"{path}/_published")
    if not fs.exists(p):
        return []
    names = sorted(f.getPath().getName() for f in fs.listStatus(p))
    return [n.split(".", 1)[1] for n in names]


def current(spark: SparkSession, path: str) -> str:
    """Folder of the published version of a dataset."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{path}/{found[-1]}"


def publish(spark: SparkSession, path: str, write, keep: int = 2) -> str:
    """``write(folder)`` into a fresh version of the dataset at ``path``, then make it the current one.

    The last ``keep`` versions stay.
    """
    version = f"v-{uuid.uuid4().hex}"
    write(f"{path}/{version}")
    fs, p = _fs(spark, f"{path}/_published")
    fs.mkdirs(p)
    names = sorted(f.getPath().getName() for f in fs.listStatus(p))
    number = int(names[-1].split(".", 1)[0]) + 1 if names else 1
    # creating a new file is atomic; its name is all there is to read
    fs.createNewFile(_fs(spark, f"{path}/_published/{number:012d}.{version}")[1])
    for old in names[:max(0, len(names) + 1 - keep)]:
        fs.delete(_fs(spark, f"{path}/_published/{old}")[1], False)
        fs.delete(_fs(spark, f"{path}/{old.split('.', 1)[1]}")[1], True)
    return f"{path}/{version}"


# facet columns searched most; rows are clustered by them inside each file so
# parquet row-group statistics let pushed-down facet filters skip data
SEARCH_CLUSTER = ["CALL_CENTER_FILTRO", "Zona", "Franja_Cartera"]


def write_detail(df: DataFrame, root: str, folder: str, job_id: str, cols=None, cluster_by=None,
                 order_by=None, text_columns=None, parts: int | None = None, alike=()) -> str:
    """Snappy parquet of the existing listed columns (all when none listed).

    ``cluster_by``: existing columns to sort by within each write task (a
    local sort, no shuffle) for row-group skipping on later searches.
    ``order_by``: store by ranges of these columns (a range shuffle) with an
    order index for pages; ``text_columns``: with trigram filters of these
    columns per range, ``alike`` those of them that repeat together.
    ``parts``: ranges (by size, if not given).
    """
    keep = existing(df, cols) if cols else list(df.columns)
    out = df.select(*[q(c) for c in keep])
    sort_cols = existing(out, cluster_by or [])

    def write(folder_):
        _put(df.sparkSession, f"{folder_}/schema.json", json.dumps({"rows": json.loads(out.schema.json()), "order": existing(out, order_by or [])}))
        if order_by:
            rows = indexes.write_ordered(out, folder_, existing(out, order_by), parts)
            if text_columns:
                indexes.write_trigram_filters(rows, folder_, text_columns, alike)
            return
        plain = out.sortWithinPartitions(*[q(c) for c in sort_cols]) if sort_cols else out
        plain.write.option("compression", "snappy").parquet(f"{folder_}/rows")

    path = job_path(root, folder, job_id)
    publish(df.sparkSession, path, write)
    return path


def write_lookup(df: DataFrame, root: str, folder: str, job_id: str, parts: int | None = None) -> str:
    """The client lookup of a job: name, client id and loan in loan order, with trigram posting lists."""
    cols = existing(df, ["Nombre_Cliente", "Cedula_Cliente", "Credito"])

    def write(folder_):
        kept = df.select(*[q(c) for c in cols])
        _put(df.sparkSession, f"{folder_}/schema.json", json.dumps({"rows": json.loads(kept.schema.json()), "order": ["Credito"]}))
        rows = indexes.write_ordered(kept, folder_, ["Credito"], parts)
        texts = [F.lower(q(c).cast("string")) if c == "Nombre_Cliente" else q(c).cast("string") for c in cols]
        indexes.write_postings(rows, folder_, texts, ["Credito"], cols)

    path = job_path(root, folder, job_id)
    publish(df.sparkSession, path, write)
    return path


def open_stored(spark: SparkSession, path: str) -> tuple[str, DataFrame, list[str]]:
    """Folder, rows (with the column that names their range, if stored by ranges) and page key of the published version."""
    folder = current(spark, path)
    meta = json.loads(_get(spark, f"{folder}/schema.json"))
    schema = T.StructType.fromJson(meta["rows"])
    if meta["order"]:
        schema = schema.add(indexes.PART, T.IntegerType())
    return folder, spark.read.schema(schema).parquet(f"{folder}/rows"), meta["order"]


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The published rows of a dataset folder."""
    return open_stored(spark, path)[1].drop(indexes.PART)


def resolve_dataset(spark: SparkSession, root: str, origin: str, job_id: str) -> DataFrame:
    """Logical origin name -> the stored dataset of one job, with the job's own columns.
    Vintage origins ``comercial_cosechas_s1..s3`` also filter their section."""
    df = read_stored(spark, origin_path(root, origin, job_id))
    sec = VINTAGE_SECTIONS.get(origin)
    return df.where(q("Grupo_Seguimiento") == sec) if sec else df


def origin_path(root: str, origin: str, job_id: str) -> str:
    base = "comercial_cosechas" if origin.startswith("comercial_cosechas") else origin
    return job_path(root, ORIGIN_FOLDERS.get(base, base), job_id)


META = T.StructType([T.StructField(n, T.StringType()) for n in ["meta_modulo", "meta_empresa", "meta_generado"]])


def write_summary(df: DataFrame, root: str, module: str, job_id: str, empresa: str | None = None,
                  generated_at: _dt.datetime | None = None) -> str:
    """Summary rows as JSON lines with metadata columns; dates as ISO text.

    The schema is kept beside the rows, so a summary is read without
    inference and an empty one has its columns.
    """
    gen = generated_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    out = dates_to_text(df).withColumns({
        "meta_modulo": F.lit(module), "meta_empresa": F.lit(empresa).cast("string"),
        "meta_generado": F.lit(gen.isoformat(timespec="seconds"))})

    def write(folder):  # rows and schema are published together
        out.write.json(f"{folder}/rows")
        _put(df.sparkSession, f"{folder}/schema.json", out.schema.json())

    path = job_path(root, f"graficos/{module}", job_id)
    publish(df.sparkSession, path, write)
    return path


def read_summary(spark: SparkSession, root: str, module: str, job_id: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """Summary of one job, by its full name (``cartera/cubo_regional``)."""
    path = current(spark, job_path(root, f"graficos/{module}", job_id))
    if schema is None:
        schema = T.StructType.fromJson(json.loads(_get(spark, f"{path}/schema.json")))
    else:
        schema = T.StructType(list(schema.fields) + list(META.fields))
    return (spark.read.schema(schema).json(f"{path}/rows")
            .withColumn("job_id", F.lit(job_id)))


def read_module(spark: SparkSession, root: str, module: str, job_id: str) -> dict[str, DataFrame]:
    """All summaries of a module (``cartera``) for one job, by their short names."""
    fs, path = _fs(spark, f"{root}/graficos/{module}")
    names = sorted(f.getPath().getName() for f in fs.listStatus(path))  # a handful of summaries, not data
    found = [n for n in names if versions(spark, job_path(root, f"graficos/{module}/{n}", job_id))]
    return {n: read_summary(spark, root, f"{module}/{n}", job_id) for n in found}


def export_filtered(df: DataFrame, path: str, visible=None) -> str:
    """Filtered rows, optional visible-column list, as a CSV with header."""
    keep = existing(df, visible) if visible else []
    out = df.select(*[q(c) for c in keep]) if keep else df
    dates_to_text(out).write.mode("overwrite").option("header", "true").csv(path)
    return path


def master_tables(root: str, job_id: str, followup_base: DataFrame | None,
                  contact_detail: DataFrame | None, contacts: DataFrame | None) -> dict:
    """The four master tables used by search; only columns that exist."""
    from collectra.schemas import (CONTACT_MASTER_COLUMNS, CONTACT_TABLE_COLUMNS,
                                   PORTFOLIO_MASTER_COLUMNS, ROLL_RATE_TABLE_COLUMNS)
    out = {}
    if followup_base is not None:
        # both tables are projections of one base: worked out once
        spark = followup_base.sparkSession
        cols = list(dict.fromkeys([*existing(followup_base, ROLL_RATE_TABLE_COLUMNS), *existing(followup_base, PORTFOLIO_MASTER_COLUMNS)]))
        base = followup_base.select(*[q(c) for c in cols])
        path = fresh_path(spark, "master-base")
        base.write.parquet(path)
        base = spark.read.schema(base.schema).parquet(path)
        out["seguimientos_rodamientos"] = write_detail(base, root, "seguimientos_rodamientos",
                                                       job_id, ROLL_RATE_TABLE_COLUMNS, SEARCH_CLUSTER)
        out["detallados_cartera"] = write_detail(base, root, "detallados_cartera", job_id,
                                                 PORTFOLIO_MASTER_COLUMNS, SEARCH_CLUSTER)
    if contact_detail is not None:
        out["seguimientos_gestion"] = write_detail(contact_detail, root, "seguimientos_gestion", job_id,
                                                   CONTACT_TABLE_COLUMNS, SEARCH_CLUSTER)
    if contacts is not None:
        out["detallados_novedades"] = write_detail(contacts, root, "detallados_novedades", job_id,
                                                   CONTACT_MASTER_COLUMNS)
    return out


def search_tables(root: str, job_id: str, contact_detail: DataFrame, portfolio: DataFrame, numbers: DataFrame | None = None,
                  parts: int | None = None) -> dict:
    """What search reads: the follow-up detail by page key with trigram filters and client
    numbers, the clients of each validity state as bitmaps, and the client lookup.

    ``numbers``: the portfolio's client numbers, if the detail was built with them;
    ``parts``: ranges of the detail.  The three are independent jobs."""
    if numbers is None:
        numbers = indexes.client_numbers(portfolio, fresh_path(portfolio.sparkSession, "clients"))
    detail = contact_detail if indexes.CLIENT in contact_detail.columns else indexes.with_client(contact_detail, numbers)
    tables = {"busqueda_gestion": lambda name: write_detail(detail, root, name, job_id, order_by=["Credito", "seq"], text_columns=SEARCH_TEXT_COLUMNS,
                                                            parts=parts, alike=portfolio.columns),
              "busqueda_validez": lambda name: write_detail(indexes.state_bitmaps(portfolio, numbers), root, name, job_id),
              "busqueda_clientes": lambda name: write_lookup(portfolio, root, name, job_id)}
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        return dict(zip(tables, pool.map(lambda name: tables[name](name), tables)))


def write_manifest(spark: SparkSession, root: str, job_id: str, empresa: str,
                   updated: _dt.datetime, stats: DataFrame | None = None) -> str:
    """Point the active report at ``job_id`` (one row, published as a whole).  ``stats``
    is an optional one-row frame of job counters carried in the manifest."""
    base = stats if stats is not None else spark.range(1).select()
    row = base.select("*", F.lit(job_id).alias("active_job_id"),
                      F.lit(updated.isoformat(timespec="seconds")).alias("fecha_actualizacion"),
                      F.lit(empresa).alias("empresa"), F.lit("ready").alias("status"))
    path = f"{root}/config/reporte_activo"
    publish(spark, path, lambda folder: row.coalesce(1).write.json(folder))
    return path


def read_manifest(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.json(current(spark, f"{root}/config/reporte_activo"))


def drop_reason(name, pattern: str = DROP_NAME_PATTERN, extensions=(".xlsx",)):
    """Rejection reason of a landed file (NULL when accepted): name pattern, then
    extension.  A report of any size is taken."""
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return (F.when(~name.contains(pattern), F.lit("name"))
            .when(~ext.isin(*[e.lower() for e in extensions]), F.lit("extension")))


def validate_drop(spark: SparkSession, folder: str, pattern: str = DROP_NAME_PATTERN,
                  extensions=(".xlsx",), glob: str = "*") -> DataFrame:
    """Landed files with an accept flag and reason.

    Uses the ``binaryFile`` source for the listing only (``path``,
    ``length``): the ``content`` column is never selected, so file bodies
    are not read.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .load(folder).select("path", "length"))
    name = F.element_at(F.split("path", "/"), -1)
    reason = drop_reason(name, pattern, extensions)
    return files.select(name.alias("name"), "length", reason.isNull().alias("accepted"), reason.alias("reason"))
