"""The reference's batch stages as one lazy DAG of DataFrames.

raw A/B -> clean (P13) -> half-step (P14) -> integrate (U4) -> transform
(A12 + F3 + P18) -> encode (E7) -> split (W8) -> {rules, profiles/clusters,
features, factorization} -> lookups.

Stage boundaries are eager checkpoints; they run when a stage is first asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.operators import cleaning as C
from tastemine.operators import encode as E
from tastemine.operators import impute as I
from tastemine.operators import integrate as U
from tastemine.operators import quality as Q
from tastemine.operators import split as S
from tastemine.session import checkpoint, release, rounds_for, scratch, settled, stored
from tastemine.sources import views as V


_SESSIONS: dict = {}


@dataclass
class Stages:
    """Lazily built, memoised stage outputs for one session and data folder.

    ``Stages.of(spark, sf_dir)`` returns the same object for the same session,
    so stage tables checkpointed once are shared by every query of the
    session (the reference likewise hands stage outputs over as files).
    """

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Stages":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _SESSIONS:
            _SESSIONS[key] = cls(spark, sf_dir)
        return _SESSIONS[key]

    def _memo(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def raw(self, source: str) -> DataFrame:
        lineitem = self._memo("lineitem", lambda: V.ordered_lineitem(self.spark, self.sf_dir))
        return self._memo(("raw", source), lambda: V.interactions_raw(self.spark, self.sf_dir, source, lineitem))

    def cleaned(self, source: str, profile: str = "full") -> C.Cleaned:
        def metrics(columns, kept):
            return Q.observed_metrics(columns, kept, C.half_step_up(F.col("rating")))
        return self._memo(("clean", source, profile), lambda: C.clean_dataset(self.raw(source), profile=profile, observe=metrics))

    def adjusted(self, source: str) -> DataFrame:
        """Cleaned + half-step adjusted (applied to both sources)."""
        return self._memo(("adj", source), lambda: C.adjust_half_step(self.cleaned(source).df))

    def integrated(self) -> U.Integrated:
        return self._memo("integ", lambda: U.integrate(
            {U.SOURCE_TAGS[0]: self.adjusted("A"), U.SOURCE_TAGS[1]: self.adjusted("B")}, unique=C.KEY_COLUMNS))

    # Stage boundaries below are stored (reliable, in spark.checkpoint.dir):
    # each later stage reads its input several times (donor aggregates, joins,
    # vocabulary and label-code jobs), and the reference hands stages over as
    # files too. A lost executor then recomputes from the last boundary.

    def integrated_table(self) -> DataFrame:
        """The integrated rows for the transform stage, which parses the genres anew: the lists of the cleaning are neither
        shuffled nor stored, their columns stand empty in their places."""
        return self._memo("integ_t", lambda: self._integrated_rows()[0])

    def _integrated_rows(self) -> tuple:
        df = self.integrated().df
        rows, remove = scratch(df.drop(*I.REBUILT_COLUMNS))
        release(self.spark)
        return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in I.REBUILT_COLUMNS else f.name
                             for f in df.schema.fields]), remove

    def transformed(self) -> DataFrame:
        """The transformed rows; the integrated ones go when these are stored, unless they were asked for themselves."""
        def build():
            rows, remove = (self._cache["integ_t"], None) if "integ_t" in self._cache else self._integrated_rows()
            pre = settled(I.transform(rows, drop_identical=False))
            if remove:
                remove()
            return I.consolidate_fields(pre, drop_identical=True)
        return self._memo("transformed", build)

    def encoded(self) -> E.Encoded:
        def build():
            split, vocab = self._encoded_split()
            return E.Encoded(split.drop("split"), vocab)
        return self._memo("encoded", build)

    def _encoded_split(self) -> tuple[DataFrame, list[str]]:
        """The encoded rows with their user's split, stored once, and the genre vocabulary. The multi-hot block is
        wide and follows from the genre list, so it is computed where it is read. The users are split in the table of their
        codes and rows take code and split from there: where it is too large to be broadcast, whole rows move for it once."""
        def build():
            rows = self.transformed()
            enc = E.preprocess_features(rows, attach={"user_idx": lambda users: stored(S.group_split(users, "user_idx"), "snappy")}).df
            enc = enc.select("user_idx", *[c for c in enc.columns if c not in ("user_idx", "split")], "split")
            table = settled(enc, "user_id", rounds_for(rows.count()))
            vocab = E.genre_vocabulary(table)
            return E.multi_hot(table, vocab), vocab
        return self._memo("encoded_split", build)

    def split(self) -> DataFrame:
        return self._encoded_split()[0]

    def part(self, name: str) -> DataFrame:
        return self.split().filter(F.col("split") == name).drop("split")

    # --- downstream stages (fan-out from the training split) -----------------------------------

    def baskets(self) -> DataFrame:
        """Part names per order (M1); mining passes over them several times."""
        from tastemine.operators import rules as R

        def build():
            li = V.table(self.spark, self.sf_dir, "lineitem").select("l_orderkey", "l_partkey")
            part = V.table(self.spark, self.sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
            return stored(R.baskets(li.join(part, "l_partkey"), "l_orderkey", "p_name"))
        return self._memo("baskets", build)

    def mined(self, min_support: float = 0.0007):
        """Rules over order baskets of part names (see catalog)."""
        from tastemine.operators import rules as R

        def build():
            fi = stored(R.frequent_itemsets(self.baskets(), min_support), "snappy")
            return R.Mined(self.baskets(), fi, R.rule_text(R.association_rules(fi)))
        return self._memo(("mined", min_support), build)

    def profiles(self) -> DataFrame:
        from tastemine.operators.profiles import user_profiles
        return self._memo("profiles", lambda: checkpoint(user_profiles(self.part("train"))))

    def features(self) -> DataFrame:
        from tastemine.operators.cluster import feature_matrix
        from tastemine.operators.profiles import profile_features

        def build():
            prof = self.profiles()
            return checkpoint(feature_matrix(prof, profile_features(prof)))
        return self._memo("features", build)

    def sweep(self):
        from tastemine.operators.cluster import k_sweep
        return self._memo("sweep", lambda: k_sweep(self.features()))

    def clustered(self, k: int | None = None):
        """(labels, users-with-labels, model) at k (default: the sweep's best k)."""
        from tastemine.operators.cluster import fit_kmeans, relabel_by_size

        def build():
            sw = self.sweep() if k is None or "sweep" in self._cache else None
            kk = k if k is not None else sw.best_k
            model = sw.models[kk] if sw is not None and kk in sw.models else fit_kmeans(self.features(), kk)
            labels = checkpoint(relabel_by_size(model.transform(self.features()).select("user_idx", "prediction")))
            return labels, self.profiles().join(labels, "user_idx"), model
        return self._memo(("clustered", k), build)

    def factorization(self):
        from tastemine.operators.factorize import factorize
        return self._memo("fact", lambda: factorize(self.part("train")))

    def recommendations(self) -> DataFrame:
        from tastemine.operators.factorize import recommend
        from tastemine.operators.rules import item_dictionary

        def build():
            titles = item_dictionary(self.part("train"))
            return checkpoint(recommend(self.factorization(), titles=titles))
        return self._memo("recs", build)


def emit(df: DataFrame, digits: int = 6, drop: tuple[str, ...] = (C.ORDER_COL,)) -> DataFrame:
    """Output convention of registered queries: drop ``row_ord``, arrays as
    ``'|'``-joined text, doubles rounded, counts as bigint."""
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.LongType):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
