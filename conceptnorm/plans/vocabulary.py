"""The normalized store: nine tables plus two denormalized serving views.

``Vocabulary.build`` runs ingest (compendia, then conflation: conflation
members resolve against the complete identifier table). ``write`` stores
every table as Parquet -- identifiers and the serving views bucketed and
sorted by CURIE (``plans.layout``), the labels in their order
(``operators.label_order``) -- and ``load`` opens a written store read-only
(A9, A12).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptnorm.operators import label_order
from conceptnorm.operators.conflate import normalize_conflation, prepare_conflation
from conceptnorm.operators.normalize import normalize_compendia
from conceptnorm.operators.keys import stage, submit
from conceptnorm.plans import layout
from conceptnorm.schema import TABLE_NAMES
from conceptnorm.session import PARQUET_CODEC, configure

@dataclass
class Vocabulary:
    types: DataFrame
    identifiers: DataFrame
    cliques: DataFrame
    descriptions: DataFrame
    identifiers_descriptions: DataFrame
    identifiers_cliques: DataFrame
    identifiers_taxa: DataFrame
    conflation_clusters: DataFrame
    conflation_members: DataFrame
    membership_wide: DataFrame
    conflation_wide: DataFrame
    cliques_wide: DataFrame

    # of a written store: its folder, and the parts of its bucketed tables
    path = None
    parts_of = None
    # the texts by identifier, of a written store in buckets
    descriptions_wide = None

    def parts(self, name: str) -> list[DataFrame]:
        """The parts of a serving table: its buckets, and the rows of CURIEs
        that have very many. Joined one by one, the buckets are used."""
        return (self.parts_of or {}).get(name) or [getattr(self, name)]

    def described(self) -> DataFrame:
        """(identifier_id, description_id, description): one row per stored description."""
        if self.descriptions_wide is not None:
            return self.descriptions_wide
        return self.identifiers_descriptions.join(
            self.descriptions.select(F.col("id").alias("description_id"), F.col("desc").alias("description")),
            "description_id").select("identifier_id", "description_id", "description")

    @classmethod
    def build(cls, records: DataFrame, conflation_lines: DataFrame | None,
              types_vocab: DataFrame, strict: bool = True, scan_order: bool = False,
              materialize: bool = True, insert_missing_taxa: bool = True) -> "Vocabulary":
        """Ingest. A strict load raises on what it can't take; a lenient one
        leaves it out and lists it in ``rejected`` (file_name, line_key,
        reason, value). ``scan_order``: inputs come from the release readers (ids by
        split, no shuffle of records). ``materialize=False`` when the store is
        written right away (the write materializes it once)."""
        configure(records.sparkSession)
        if conflation_lines is None:
            spark = records.sparkSession
            conflation_lines = spark.createDataFrame(
                [], "file_name string, conflation_type int, file_ord int, file_path string, "
                    "split_start bigint, row_in_split bigint, value string")
        # the two halves are independent until conflation members resolve
        # against identifiers: parse/number/stage the clusters meanwhile
        with ThreadPoolExecutor(max_workers=1) as pool:
            pending = submit(pool, prepare_conflation, conflation_lines, strict, scan_order)
            comp = normalize_compendia(records, types_vocab, strict=strict,
                                       scan_order=scan_order, materialize=materialize,
                                       insert_missing_taxa=insert_missing_taxa)
            prepared = pending.result()
        conf = normalize_conflation(conflation_lines, comp.identifiers, strict=strict,
                                    scan_order=scan_order, prepared=prepared)
        store = cls(
            types=comp.types, identifiers=comp.identifiers, cliques=comp.cliques,
            descriptions=comp.descriptions,
            identifiers_descriptions=comp.identifiers_descriptions,
            identifiers_cliques=comp.identifiers_cliques,
            identifiers_taxa=comp.identifiers_taxa,
            conflation_clusters=conf.conflation_clusters,
            conflation_members=conf.conflation_members,
            membership_wide=comp.membership_wide,
            cliques_wide=comp.cliques_wide,
            conflation_wide=(stage(conf.conflation_wide, "conflation") if materialize
                             else conf.conflation_wide),
        )
        store.rejected = comp.rejected.unionByName(conf.rejected)
        store.descriptions_wide = comp.descriptions_wide
        return store

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame]) -> "Vocabulary":
        """A store given as the nine tables alone (e.g. written by another
        loader): the serving views are derived by joins. A member's position
        is 0 for the clique's primary and 1 otherwise."""
        ids = tables["identifiers"]
        types = tables["types"]
        cliques_wide = (tables["cliques"]
                        .join(ids.select(F.col("id").alias("primary_identifier_id"),
                                         F.col("curie").alias("primary_curie")),
                              "primary_identifier_id")
                        .join(types.select(F.col("id").alias("type_id"),
                                           F.col("curie").alias("type_curie")), "type_id")
                        .select(F.col("id").alias("clique_id"), "primary_curie",
                                "primary_identifier_id", "type_curie", "ic", "preferred_name"))
        membership_wide = (tables["identifiers_cliques"]
                           .join(ids.select(F.col("id").alias("identifier_id"),
                                            F.col("curie").alias("member_curie"),
                                            F.col("label").alias("member_label")),
                                 "identifier_id")
                           .join(cliques_wide, "clique_id")
                           .select("member_curie", F.col("identifier_id").alias("member_id"),
                                   "member_label", "clique_id",
                                   F.when(F.col("identifier_id") == F.col("primary_identifier_id"),
                                          0).otherwise(1).alias("pos"),
                                   "primary_curie", "primary_identifier_id", "type_curie", "ic",
                                   "preferred_name"))
        conflation_wide = (tables["conflation_members"]
                           .join(tables["conflation_clusters"]
                                 .select(F.col("id").alias("cluster_id"),
                                         F.col("type").alias("conflation_type")), "cluster_id")
                           .join(ids.select(F.col("id").alias("identifier_id"),
                                            F.col("curie").alias("member_curie")), "identifier_id")
                           .select("cluster_id", "conflation_type", "member_curie",
                                   F.col("identifier_id").alias("member_id"),
                                   (1 - F.col("is_canonical")).alias("pos"), "is_canonical"))
        return cls(**{name: tables[name] for name in TABLE_NAMES},
                   membership_wide=membership_wide, conflation_wide=conflation_wide,
                   cliques_wide=cliques_wide)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_NAMES}

    def all_frames(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def write(self, path: str, mode: str = "overwrite", parallel: int = 8,
              heavy_rows: int | None = None) -> None:
        """One Parquet folder per table, the serving tables bucketed by
        CURIE, and the label order.

        The tables are independent jobs; up to ``parallel`` are submitted at
        once from driver threads so small tables do not leave the cluster
        idle while a large one finishes."""
        path, spark = path.rstrip("/"), self.identifiers.sparkSession
        if mode != "overwrite":
            raise ValueError("a store is written anew; operators.append adds rows to one")
        buckets = layout.bucket_count(spark, self.identifiers.count())
        ids = {"membership_wide": (self.identifiers_cliques, "identifier_id"),
               "conflation_wide": (self.conflation_members, "identifier_id"),
               "cliques_wide": (self.cliques, "primary_identifier_id")}

        def write_one(item: tuple[str, DataFrame]) -> tuple[str, int, bool] | None:
            name, df = item
            if name not in layout.BUCKETED:
                df.write.mode("overwrite").option("compression", PARQUET_CODEC).parquet(f"{path}/{name}")
                return None
            heavy = layout.heavy_ids(*ids[name], heavy_rows) if name in ids else None
            heavy = heavy if heavy is not None and heavy.head(1) else None
            layout.write_table(df, path, name, buckets, heavy)
            return name, buckets, heavy is not None

        # the largest (serving) tables first, so the small ones fill in
        frames = sorted(self.all_frames().items(), key=lambda kv: kv[0] not in layout.BUCKETED)
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            labels = pool.submit(label_order.write, self.identifiers, path)
            texts = pool.submit(layout.write_table, self.described(), path, layout.DESCRIPTIONS, buckets)
            written = [f.result() for f in [pool.submit(write_one, item) for item in frames]]
            labels.result(), texts.result()
        layout.write_layout(spark, path, [*(w for w in written if w), (layout.DESCRIPTIONS, buckets, False)])

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Vocabulary":
        """Open a written store (immutable by construction)."""
        configure(spark)
        path = path.rstrip("/")
        frames = {f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(cls)
                  if f.name not in layout.BUCKETED}
        found, parts = layout.layout(spark, path), {}
        for name in layout.BUCKETED:
            if name not in found:
                parts[name] = [spark.read.parquet(f"{path}/{name}")]
            else:
                buckets, heavy = found[name]
                own = layout.open_table(spark, path, name, buckets)
                parts[name] = [own] + ([spark.read.parquet(f"{path}/{name}_heavy").select(*own.columns)] if heavy else [])
            frames[name] = parts[name][0] if len(parts[name]) == 1 else parts[name][0].unionByName(parts[name][1])
        store = cls(**frames)
        store.path, store.parts_of = path, parts
        if layout.DESCRIPTIONS in found:
            store.descriptions_wide = layout.open_table(spark, path, layout.DESCRIPTIONS, found[layout.DESCRIPTIONS][0])
        return store

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.all_frames().items():
            df.createOrReplaceTempView(prefix + name)


def max_id(df: DataFrame) -> DataFrame:
    """The largest id of a table (NULL when empty)."""
    return df.agg(F.max("id").alias("max_id"))
