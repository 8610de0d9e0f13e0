"""What the planner makes of the queries: no all-pairs joins, pruned columns, pushed filters."""

import re

import pytest
from pyspark.sql import functions as F

from phasegrid.operators import raster
from phasegrid.plans import bindings, queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["slc_pairs", "orbit_interval_match", "burst_match", "interferogram", "coherence", "box_mean_mirror", "bilinear", "residues", "priority_mosaic_first"])
def test_no_pair_joins(spark, sf, name):
    text = plan_of(queries.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_graph_meets_pixels_as_one_row(spark, sf):
    """The only nested-loop join of the flagship has an aggregate without keys on one side."""
    text = plan_of(queries.QUERIES["stack_velocity_mad"](spark, sf))
    assert "CartesianProduct" not in text
    joins = re.findall(r"BroadcastNestedLoopJoin.*", text)
    assert joins and all("Cross" in j or "Inner" in j for j in joins)
    assert text.count("collect_list(struct(date1") >= 1


def test_columns_and_filters_reach_the_scan(spark, sf):
    text = plan_of(queries.QUERIES["scene_filter"](spark, sf))
    scan = next(line for line in text.splitlines() if "documents.parquet" in line)
    assert "In(source" in scan and "In(lang" in scan and "text" not in scan.partition("ReadSchema")[2]
    text = plan_of(queries.QUERIES["multilook_real"](spark, sf))
    scan = next(line for line in text.splitlines() if "embeddings.parquet" in line)
    assert "label" not in scan.partition("ReadSchema")[2]


def test_block_averages_combine_before_the_shuffle(spark, sf):
    text = plan_of(raster.multilook(bindings.embedding_pixels(spark, sf), 500, 64, (10, 4), ["v"]))
    assert text.count("HashAggregate") == 2 and text.count("Exchange hashpartitioning") == 1
    text = plan_of(raster.mosaic(bindings.embedding_pixels(spark, sf).withColumn("p", F.lit(1)), "p", ["v"], F.col("v") > 0))
    assert "partial_min_by" in text and "Window" not in text


def test_pixel_chain_shuffles_once_per_use(spark, sf):
    """After the phases are gathered by pixel, screening and stacking exchange nothing more."""
    text = plan_of(queries.QUERIES["stack_velocity_mad"](spark, sf))
    by_pixel = [line for line in text.splitlines() if re.search(r"Exchange hashpartitioning\(px#\d+, \d+\)", line)]
    assert len(by_pixel) <= 3
