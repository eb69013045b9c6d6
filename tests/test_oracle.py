"""Registered queries against their DuckDB oracle on the smallest tables, and
the driver smoke entry."""

import importlib
import os
import sys

import pytest

from conftest import SF_SMALL

FAST = ["clean", "clean_stats", "clean_basic", "rating_balance", "integrate", "integrate_stats",
        "impute_mode_raw", "imputation_audit", "transform", "encode", "tfidf_cast", "split_report", "split_index",
        "frequent_itemsets", "association_rules", "rule_lookup_exact", "user_genre_prefs", "cluster_profiles",
        "embedding_silhouette", "embedding_calinski_harabasz", "quality_report", "missing_comparison",
        "genre_parse_variants", "identical_columns", "rating_histogram", "matrix_shape", "served_lookup", "segment_cards", "segment_insight", "rule_labels", "io_csv", "io_sparse",
        "rule_lookup_fuzzy", "title_matches_fuzzy", "title_matches_report", "svd_reconstruction", "svd_energy", "embedding_top_products",
        "embedding_silhouette_euclidean", "held_out_popular", "held_out_popular_users", "persisted_encoders", "rating_density",
        "distinct_sketches", "split_threshold", "inferred_clusters", "feature_projection_norms"]


@pytest.fixture(scope="module")
def compare():
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    return importlib.import_module("compare")


def test_every_oracle_has_a_query():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, compare, name):
    res = compare.run(spark, SF_SMALL, [name], verbose=True)
    assert res[name][0] == "MATCH", res[name]


def test_entry_smoke(spark):
    import __spark_entry__ as e
    out = e.entry(spark)
    r = out.collect()
    assert len(r) == 2 and r[0]["verdict"] in ("balanced", "moderately-imbalanced", "imbalanced")
