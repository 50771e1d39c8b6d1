"""Wire the layers together: bronze stand-ins -> silver -> gold -> marts.

Every function returns lazy DataFrames; ``materialize`` writes each layer and reads it
back, which cuts the lineage (executor loss then recomputes one layer, not the DAG).
"""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.quality import write_counting_nulls
from ledgerlake.operators.versions import KeyRegistry, VersionLog
from ledgerlake.plans import checks, gold, marts, silver, standins
from ledgerlake.plans.config import WarehouseConfig
from ledgerlake.plans.tables import Tables
from ledgerlake.sources import calendar
from ledgerlake.session import run_folder


def layer(fn=None, *, cut: bool = True):
    """Build a layer once per warehouse.  Layers with joins, windows or key numbering are
    written as Parquet into the shared ``spark.checkpoint.dir`` and read back, so
    downstream plans start from files and a lost executor recomputes one layer only;
    single-scan projections (``cut=False``) are cheaper to recompute than to write.  The NULLs that
    the declared checks ask for are counted on the way (``Warehouse.null_counts``)."""
    def deco(f):
        @functools.wraps(f)
        def wrapper(self):
            if f.__name__ not in self._memo:
                df = f(self)
                self._memo[f.__name__] = self._written(df, f.__name__, f.__name__) if (self.cut and cut) else df
            return self._memo[f.__name__]
        return wrapper
    return deco(fn) if fn is not None else deco


class _Seeds(dict):
    """Seeds, each written once on first use (they are derived by joins of the source
    tables; written, their exact small size lets AQE broadcast them)."""

    def __init__(self, lazy: dict, write=None):
        super().__init__()
        self._lazy, self._write = lazy, write

    def __getitem__(self, name):
        if not dict.__contains__(self, name):
            df = self._lazy[name]
            dict.__setitem__(self, name, df if self._write is None else self._write(df, f"seed_{name}", name))
        return dict.__getitem__(self, name)

    def keys(self):
        return self._lazy.keys()

    def __iter__(self):
        return iter(self._lazy)

    def __contains__(self, name):
        return name in self._lazy

    def items(self):
        return [(k, self[k]) for k in self._lazy]


class Warehouse:
    """The layered models over one set of inputs.

    With only ``sf_dir`` the bronze tables, seeds and configuration are stand-ins derived from
    the test tables.  A real deployment passes all three of its own: ``bronze`` frames (keys
    as in ``standins.bronze``: fenix_facturas, fenix_tranfac, ...), ``seeds``
    (``plans.seeds.read_seeds`` plus the ``puntos_emision`` and ``facturas_excluidas`` feature
    tables) and a ``WarehouseConfig``.  Nothing is mixed: a missing input raises by name.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, cut: bool = True,
                 bronze: dict | None = None, seeds: dict | None = None, strict: bool = False,
                 config: WarehouseConfig | None = None, previous: dict | None = None):
        self.spark = spark
        self.previous = previous or {}     # last snapshots of d_articles, d_customers, ...: ids stay
        self.strict = strict          # fail on the source models' fan-outs (T-07)
        if bronze is None and seeds is None and config is None:
            if sf_dir is None:
                raise ValueError("give sf_dir for the stand-ins, or bronze, seeds and config")
            t = Tables(spark, sf_dir)
            bronze, seeds, config = standins.bronze(t), standins.seeds(t), standins.CONFIG
        given = {"bronze": (bronze or {}, standins.BRONZE_NAMES), "seeds": (seeds or {}, standins.SEED_NAMES)}
        missing = [f"{kind}.{n}" for kind, (have, names) in given.items() for n in names if n not in have]
        missing += ["config"] if config is None else []
        if missing:
            raise ValueError("missing warehouse inputs: " + ", ".join(missing))
        self.bronze, self.config = dict(bronze), config
        self.seeds = _Seeds(dict(seeds), self._written if cut else None)
        self.cut = cut
        self._memo: dict = {}
        #: Partitions by invoice that the fact is dealt to (None: as Spark plans it).
        self.fact_buckets: int | None = None
        #: NULLs of (model, column), counted when the model was written.
        self.null_counts: dict[tuple[str, str], int] = {}

    def _written(self, df: DataFrame, name: str, model: str) -> DataFrame:
        columns = [ch.column for ch in checks.WAREHOUSE_CHECKS if ch.kind == "not_null" and ch.model == model]
        out, nulls = write_counting_nulls(df, columns, name)
        self.null_counts.update({(model, c): n for c, n in nulls.items()})
        return out

    # dependency waves: every layer of a wave only needs layers of earlier waves
    WAVES = (("seeds", "s_requests", "d_customers", "d_sellers", "d_codes"),
             ("s_first_requests", "d_articles", "d_dates"),
             ("s_invoices",),
             ("d_invoices", "commercial_docs", "agent_docs"),
             ("staged",),
             ("billed",))

    #: What a layer reads of the seeds ("seed:...") and of other layers that are written.
    NEEDS = {
        "s_articles": ("seed:fenix_articulos_corregidos",),
        "s_first_requests": ("s_requests",),
        "s_invoices": ("s_requests", "s_first_requests", "seed:puntos_emision", "seed:reasignacion_islas_temporales"),
        "d_articles": ("s_articles", "seed:articulos_comercial"),
        "d_invoices": ("s_invoices", "s_requests", "s_first_requests", "d_codes", "seed:facturas_excluidas"),
        "commercial_docs": ("s_invoices", "d_articles", "d_customers", "d_sellers", "seed:vendedores_comercial",
                            "seed:reasignacion_articulos_comercial", "seed:reasignacion_comercial"),
        "agent_docs": ("s_invoices", "d_sellers", "seed:vendedores_agentes"),
        "staged": ("s_invoices", "d_invoices", "d_customers", "d_sellers", "d_articles", "d_codes", "commercial_docs",
                   "agent_docs", "seed:facturas_excluidas", "seed:reasignacion_distribuidores",
                   "seed:reasignacion_periodo_fiscal", "seed:reasignacion_subtotal", "seed:reasignacion_grupo_vendedor"),
        "billed": ("staged",),
    }

    def _needed(self, layers) -> set[str]:
        """The layers and all that they read, directly or not."""
        found, open_ = set(), list(layers)
        while open_:
            name = open_.pop()
            if name not in found:
                found.add(name)
                open_.extend(self.NEEDS.get(name, ()))
        return found

    def build(self, *layers: str, workers: int = 8) -> "Warehouse":
        """Write every layer once; with ``layers`` only these and what they read.  Layers of one
        wave are independent Spark jobs submitted from a few driver threads, so small writes overlap
        instead of queueing.  The caller's job group / scheduler pool are carried into the worker
        threads."""
        sc = self.spark.sparkContext
        props = {k: sc.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description",
                                                      "spark.scheduler.pool")}
        needed = self._needed(layers) if layers else None

        def run(name):
            for k, v in props.items():
                if v is not None:
                    sc.setLocalProperty(k, v)
            if name.startswith("seed:"):
                self.seeds[name[5:]]
            else:
                getattr(self, name)()
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for wave in self.WAVES:
                tasks = [t for w in wave for t in ([f"seed:{s}" for s in self.seeds] if w == "seeds" else [w])]
                list(pool.map(run, [t for t in tasks if needed is None or t in needed]))
        return self

    # silver -------------------------------------------------------------------------
    @layer
    def s_requests(self):
        return silver.requests(self.bronze["camunda_operatividad"])

    @layer(cut=False)
    def s_articles(self):
        return silver.articles(self.bronze["fenix_articulos"], self.seeds["fenix_articulos_corregidos"])

    @layer(cut=False)
    def s_customers(self):
        return silver.customers(self.bronze["fenix_clientes"], self.config.corporate_cifs)

    @layer(cut=False)
    def s_codes(self):
        return silver.codes(self.bronze["fenix_codigos"])

    @layer(cut=False)
    def s_lines(self):
        return silver.lines(self.bronze["fenix_tranfac"])

    @layer(cut=False)
    def s_sellers(self):
        return silver.sellers(self.bronze["fenix_vendedores"])

    @layer
    def s_first_requests(self):
        return silver.first_request_per_invoice(self.s_requests())

    @layer
    def s_invoices(self):
        return silver.invoices(self.bronze["fenix_facturas"], self.s_requests(), self.s_codes(),
                               self.seeds["puntos_emision"], self.seeds["reasignacion_islas_temporales"],
                               first_req=self.s_first_requests(), expect_unique=self.strict)

    # gold ---------------------------------------------------------------------------
    @layer
    def d_articles(self):
        return gold.dim_articles(self.s_articles(), self.seeds["articulos_comercial"], self.s_lines(),
                                 self.previous.get("d_articles"))

    @layer
    def d_customers(self):
        return gold.dim_customers(self.s_customers(), self.previous.get("d_customers"))

    @layer
    def d_sellers(self):
        return gold.dim_sellers(self.s_sellers(), self.previous.get("d_sellers"))

    @layer
    def d_codes(self):
        return gold.dim_codes(self.s_codes())

    @layer
    def d_invoices(self):
        return gold.dim_invoices(self.s_invoices(), self.s_requests(), self.d_codes(),
                                 self.seeds["facturas_excluidas"], first_req=self.s_first_requests(),
                                 previous=self.previous.get("d_invoices"))

    @layer
    def commercial_docs(self):
        return gold.commercial_documents(self.s_invoices(), self.s_lines(), self.d_articles(), self.d_customers(),
                                         self.d_sellers(), self.seeds, self.config)

    @layer
    def agent_docs(self):
        return gold.agent_documents(self.s_invoices(), self.d_sellers(), self.seeds)

    @layer
    def staged(self):
        """The staging with equal rows kept once (``gold.COPIES``)."""
        return gold.staged_lines(self.s_invoices(), self.s_lines(), self.d_invoices(), self.d_customers(),
                                 self.d_sellers(), self.d_articles(), self.d_codes(), self.seeds, self.config,
                                 commercial=self.commercial_docs(), agents=self.agent_docs(),
                                 expect_unique=self.strict)

    @layer(cut=False)
    def billed(self):
        """The fact with equal rows kept once; its lines lie in the staging, only credit notes move."""
        return gold.fact_billing(self.staged(), self.fact_buckets)

    def staging(self):
        return self._memo["staging"] if "staging" in self._memo else gold.expand(self.staged()).drop(gold.SUM)

    def fact(self):
        return self._memo["fact"] if "fact" in self._memo else gold.expand(self.billed())

    def _billing(self):
        """What the marts read: the stored fact, or the compact one."""
        return self._memo["fact"] if "fact" in self._memo else self.billed()

    @layer
    def d_dates(self):
        return calendar.dim_date(calendar.date_spine(self.spark))

    # marts --------------------------------------------------------------------------
    def m_agreements_customers(self):
        return marts.agreements_customers(self.d_invoices(), self._billing(), self.d_customers())

    def m_agreements_invoices(self):
        return marts.agreements_invoices(self.d_invoices(), self._billing())

    def m_indirect(self):
        return marts.indirect_channel(self._billing(), self.d_codes(), self.d_invoices(), self.config)

    def m_agreements_fact(self):
        return marts.agreements_fact(self._billing(), self.d_invoices())

    def m_sales(self):
        return marts.sales(self._billing(), self.d_codes(), self.d_invoices(), self.d_articles(),
                           expect_unique=self.strict)


def bucket_count(df, bucket_bytes: int = 1 << 30) -> int:
    """Buckets of about ``bucket_bytes`` from the optimizer's size estimate of the frame."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(65536, -(-size // bucket_bytes)))


#: Stored name and bucket key (None: plain Parquet) of each layer, in build order.
TABLES = (("s_requests", "silver_camunda_operatividad", None), ("s_articles", "silver_fenix_articulos", None),
          ("s_customers", "silver_fenix_clientes", None), ("s_codes", "silver_fenix_codigos", None),
          ("s_lines", "silver_fenix_tranfac", "codigo_factura"), ("s_sellers", "silver_fenix_vendedores", None),
          ("s_first_requests", "silver_first_requests", None), ("s_invoices", "silver_fenix_facturas", "codigo_factura"),
          ("d_articles", "gold_dim_articulos", None), ("d_customers", "gold_dim_clientes", None),
          ("d_sellers", "gold_dim_vendedores", None), ("d_codes", "gold_dim_codigos", None),
          ("d_invoices", "gold_dim_facturas", "codigo_factura"), ("d_dates", "gold_dim_fecha", None),
          ("commercial_docs", "gold_documentos_comerciales", None), ("agent_docs", "gold_documentos_agentes", None),
          ("staging", "gold_fact_staging", None), ("fact", "gold_fact_facturacion", "id_factura"))


#: Dimensions with surrogate keys: layer -> (natural key, id), for the key registry.
KEYED = {"d_articles": ("codigo_articulo", "id_articulo"), "d_customers": ("codigo_cliente", "id_cliente"),
         "d_sellers": ("codigo_vendedor", "id_vendedor"), "d_invoices": ("codigo_factura", "id_factura")}


def materialize(spark: SparkSession, sf_dir: str | None, out_dir: str, buckets: int | None = None,
                database: str = "ledgerlake", bronze: dict | None = None,
                seeds: dict | None = None, strict: bool = False,
                config: WarehouseConfig | None = None, previous: dict | None = None,
                keep_versions: int = 2) -> dict[str, str]:
    """The production job: the same layers as ``Warehouse.build``, each written once (full
    refresh) and read back, so every layer starts from files, not from the upstream lineage.

    All layers go to new folders and are published together at the end as one version of
    ``out_dir`` (``operators.versions``): a run that fails leaves the last version as it is.
    Stored tables are ``database.<name>``, views over the newest version's files.  Versions beyond
    ``keep_versions`` are removed after a success, as are the run's intermediate tables.

    Silver invoice headers, lines and the invoice dimension are stored bucketed by the
    invoice key with the same bucket count, so the header x line x invoice-dimension
    joins of the fact read all three in place (co-located, no shuffle of the largest
    table).  The fact is stored bucketed by its invoice id, in the layout its cents allocation
    leaves, so the marts join it to the invoice dimension in place: only the dimension's ids move.
    ``buckets`` defaults to about 1 GB of lines a bucket.  Marts stay views over the fact.

    Surrogate ids come from the key registry in ``out_dir``: known natural keys keep theirs, also
    after years away.  ``previous`` maps dimension layers to (id, natural key) snapshots that take
    the registry's place, for a first run over dimensions built elsewhere.
    """
    log = VersionLog(spark, out_dir)
    since = log.version()
    registries = {layer: KeyRegistry(log, layer, [natural], id_col) for layer, (natural, id_col) in KEYED.items()}
    known = {layer: df for layer, r in registries.items() if (df := r.read(since)) is not None}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    with run_folder(spark):
        w = Warehouse(spark, sf_dir, cut=False, bronze=bronze, seeds=seeds, strict=strict, config=config,
                      previous=known | (previous or {}))
        w.seeds = _Seeds(w.seeds._lazy, w._written)
        buckets = buckets or bucket_count(w.s_lines())
        w.fact_buckets = buckets
        tables: dict[str, dict] = {}
        for layer_name, name, key in TABLES:
            if layer_name == "staging":         # written once in its compact form, for both tables of lines
                w._memo["staged"] = w._written(w.staged(), "staged", "staged")
            df = getattr(w, layer_name)()
            if key is None:
                tables[name] = log.write(name, df)
                w._memo[layer_name] = spark.read.parquet(log.path(tables[name]["folders"][0]))
                continue
            folder = log.folder(name)
            stored = f"{database}.{folder.split('/')[1].replace('-', '_')}"
            # one writer task per bucket, so each bucket is one file; the fact is in that layout
            laid = df if layer_name == "fact" else df.repartition(buckets, key)
            (laid.write.option("path", log.path(folder))
             .bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(stored))
            tables[name] = {"folders": [folder], "stored": stored}
            w._memo[layer_name] = spark.table(stored)
        for layer, registry in registries.items():
            if layer in known or not previous or layer not in previous:
                tables |= registry.extend(getattr(w, layer)(), since)
            else:                               # ids given elsewhere: all of them, present or not
                given = previous[layer].select(registry.id_col, *registry.key_cols)
                tables |= registry.extend(given.unionByName(getattr(w, layer)().select(*given.columns)), since)
        log.commit(since, tables)
        for name, entry in tables.items():
            if "stored" in entry:
                _point(spark, f"{database}.{name}", entry["stored"])
        paths = {name: log.path(entry["folders"][0]) for name, entry in tables.items() if not name.startswith("keys_")}
        for name, df in (("mart_dim_clientes_convenios", w.m_agreements_customers()),
                         ("mart_dim_facturas_convenios", w.m_agreements_invoices()),
                         ("mart_fact_canal_indirecto", w.m_indirect()),
                         ("mart_fact_facturacion_convenios", w.m_agreements_fact()),
                         ("mart_fact_facturacion_ventas", w.m_sales())):
            df.createOrReplaceTempView(name)   # marts are views over the written fact
            paths[name] = "view"
    _retire(log, database, keep_versions)
    return paths


def _point(spark: SparkSession, view: str, stored: str) -> None:
    """Let the view read the stored table (a table of an earlier layout makes way)."""
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        spark.sql(f"DROP TABLE {view}")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {stored}")


def _retire(log: VersionLog, database: str, keep: int) -> None:
    """Remove versions beyond ``keep`` and the catalog entries of the folders that went with them."""
    for folder in log.vacuum(keep):
        log.spark.sql(f"DROP TABLE IF EXISTS {database}.{folder.replace('-', '_')}")


def read_layer(spark: SparkSession, out_dir: str, name: str, version: int | None = None) -> DataFrame:
    """A layer of a published version (default: the newest)."""
    return VersionLog(spark, out_dir).table(name, version)
