"""Registered corpus queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers

from . import (
    bm25,
    licenses,
    main_text,
    minhash,
    mixing,
    periodic_runs,
    pii,
    resampling,
    rules,
    secret_scan,
    suffixes,
    token_counts,
    warc,
)
from .common import table


def op1_suffix_dedup(spark, d):
    return suffixes.remove_repeats(table(spark, d, "documents"))


def op2_mixing_sources(spark, d):
    return mixing.mix(table(spark, d, "documents"))


def op3_minhash(spark, d):
    return minhash.near_duplicates(table(spark, d, "documents"))


def op4_license_scan(spark, d):
    return licenses.scan(table(spark, d, "documents"))


def op5_decontamination(spark, d):
    return bm25.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op6_quality_rules(spark, d):
    return rules.quality(table(spark, d, "documents"))


def op7_secret_scan(spark, d):
    return secret_scan.scan(table(spark, d, "documents"))


def op8_warc(spark, d):
    return warc.round_trip(table(spark, d, "pages"))


def op9_pii(spark, d):
    return pii.scan(table(spark, d, "documents"))


def op10_main_text(spark, d):
    return main_text.extract(table(spark, d, "pages"))


def op11_resampling(spark, d):
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op12_token_counts(spark, d):
    return token_counts.token_counts(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_periodic_runs(spark, d):
    return periodic_runs.periodic_runs(table(spark, d, "documents"), periodic_runs.planted)


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op")}


def oracle_sql():
    return {
        "op2_mixing_sources": mixing.ORACLE,
        "op6_quality_rules": rules.ORACLE,
        "op8_warc": warc.ORACLE,
    }
