"""``python -m phasegrid COMMAND CONFIG``: the steps over Parquet tables named by the configuration."""

from __future__ import annotations

import argparse
import json
import os
import sys

import yaml

from phasegrid import config
from phasegrid.plans import drivers

COMMANDS = ("init", "subconfig", "integrity", "slcpairs", "interfere", "coherence", "phasecorr", "scatterers", "unwrap", "timeseries")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="phasegrid")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("config")
    parser.add_argument("--rows", type=int, default=0, help="rows of the images")
    parser.add_argument("--cols", type=int, default=0, help="columns of the images")
    parser.add_argument("--scenes", help="catalogue table, for subconfig")
    parser.add_argument("--delays", help="delay table, for phasecorr")
    parser.add_argument("--mask", help="validity mask, for timeseries")
    parser.add_argument("--candidates", help="table (r, c, ps) of scatterer candidates, for scatterers")
    parser.add_argument("--output", help="table that scatterers writes")
    parser.add_argument("--neighbours", type=int, default=20, help="nearest scatterers a pixel is compared with")
    parser.add_argument("--radii", type=int, nargs=2, default=(0, 20), help="radii that they lie between")
    parser.add_argument("--thresholds", type=float, nargs=2, default=(0.3, 0.5), help="least median and maximum similarity")
    parser.add_argument("--wavelength", type=float, default=0.055465763)
    a = parser.parse_args(argv)
    if a.command == "init":
        if os.path.exists(a.config):
            parser.error(f"{a.config} is there already")
        config.save(config.Config(), a.config)
        return 0
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from phasegrid.session import SETTINGS

    builder = SparkSession.builder.appName(f"phasegrid {a.command}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark, c = builder.getOrCreate(), config.load(a.config)
    at = lambda folder, name: os.path.join(folder, name)
    looks = (c.looks.rows, c.looks.cols)
    out_rows, out_cols = a.rows // looks[0], a.cols // looks[1]
    if a.command == "subconfig":
        for path, made in drivers.per_path(spark.read.parquet(a.scenes), config.load(a.config, relative=False)):
            with open(at(os.path.dirname(os.path.abspath(a.config)), f"path{path}.yml"), "w") as f:
                yaml.safe_dump(made, f, sort_keys=False)
        return 0
    images = lambda: spark.read.parquet(at(c.io.scenes, "images"))
    ifgs = lambda: spark.read.parquet(c.io.interferograms)
    if a.command == "integrity":
        dates, mask = drivers.integrity(images(), 0.1)
        dates.write.mode("overwrite").parquet(at(c.io.scenes, "integrity"))
        mask.write.mode("overwrite").parquet(at(c.io.scenes, "mask"))
    elif a.command == "slcpairs":
        drivers.slc_pairs(images(), (c.pairs.min_days, c.pairs.max_days)).write.mode("overwrite").parquet(at(c.io.scenes, "pairs"))
    elif a.command == "interfere":
        made = drivers.interfere(images(), spark.read.parquet(at(c.io.scenes, "pairs")), a.rows, a.cols, looks)
        made.write.mode("overwrite").parquet(c.io.interferograms)
    elif a.command == "coherence":
        drivers.coherence(images(), ifgs(), a.rows, a.cols, looks).write.mode("overwrite").parquet(c.io.interferograms.rstrip("/") + "_coherence")
    elif a.command == "phasecorr":
        made = drivers.phase_correction(ifgs(), spark.read.parquet(a.delays), a.wavelength, out_rows, out_cols, c.filter)
        made.write.mode("overwrite").parquet(c.io.corrected)
    elif a.command == "scatterers":
        stack = ifgs().withColumn("ifg", F.struct("date1", "date2")).drop("date1", "date2")
        made = drivers.scatterers(stack, spark.read.parquet(a.candidates), out_rows, out_cols, a.neighbours, tuple(a.radii), *a.thresholds)
        made.write.mode("overwrite").parquet(a.output)
    elif a.command == "unwrap":
        source = spark.read.parquet(c.io.corrected) if c.io.corrected else ifgs()
        drivers.batch_unwrap(source, shape=(out_rows, out_cols)).write.mode("overwrite").parquet(c.io.unwrapped)
    else:
        mask = spark.read.parquet(a.mask) if a.mask else None
        made = drivers.time_series(spark.read.parquet(c.io.unwrapped), (out_rows, out_cols), c.timeseries, mask, a.wavelength)
        made.write.mode("overwrite").parquet(c.io.output)
        print(json.dumps({"method": c.timeseries.method, "output": c.io.output}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
