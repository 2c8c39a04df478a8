"""Plan documents: JSON that names layers and steps, compiled to one DataFrame graph.

A plan is {"layers": [{"id", "kind", ...parameters}]}; each kind is a function of a
pixel table. Nothing runs until the result is read: Catalyst sees all steps of all
layers at once, and layers share the scan of their source.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import colour
from ..operators import classify, ramps, regions

KINDS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {}


def kind(name: str):
    def add(f):
        KINDS[name] = f
        return f

    return add


def legend_of(layer: dict) -> list[classify.Prototype]:
    """Prototypes of a legend, one or more colours a class; a class's number is its place in the list."""
    out = []
    for k, entry in enumerate(layer["legend"], 1):
        colours = entry["rgb"]
        for rgb in colours if isinstance(colours[0], list) else [colours]:
            out.append((k, tuple(rgb)))
    return out


def in_lab(pixels: DataFrame) -> DataFrame:
    """Adds Lab columns.

    The conversion is bound to a name by a one-element transform, so that distances to
    many prototypes read it instead of each repeating it in generated code.
    """

    def convert(c):
        light, a, b = colour.lab8(c["r"], c["g"], c["b"])
        return F.struct(light.alias("l"), a.alias("a"), b.alias("b"))

    one = pixels.withColumn("_lab", F.explode(F.transform(F.array(F.struct("r", "g", "b")), convert)))
    return one.withColumns({f"lab_{c}": F.col(f"_lab.{c}") for c in "lab"}).drop("_lab")


def lab_prototypes(pixels: DataFrame, layer: dict) -> list[classify.Prototype]:
    """Legend colours in Lab, converted by the same column expressions as the pixels."""
    rows = [(k, *map(int, rgb)) for k, rgb in legend_of(layer)]
    found = in_lab(pixels.sparkSession.createDataFrame(rows, "k int, r int, g int, b int")).collect()
    return [(r["k"], (float(r["lab_l"]), float(r["lab_a"]), float(r["lab_b"]))) for r in found]


@kind("categorical")
def categorical(pixels: DataFrame, layer: dict) -> DataFrame:
    protos = lab_prototypes(pixels, layer)
    step = lambda c: classify.classify(in_lab(c), ["lab_l", "lab_a", "lab_b"], protos, max_distance=layer.get("max_distance"), min_margin=layer.get("min_margin"))
    return classify.by_distinct(pixels, ["r", "g", "b"], step).select("y", "x", "class_id")


@kind("grayscale_categorical")
def grayscale(pixels: DataFrame, layer: dict) -> DataFrame:
    """Nearest grey among centres, for pixels of little chroma."""
    greys = [(k, (float(entry["gray"]),)) for k, entry in enumerate(layer["legend"], 1)]
    spread = F.greatest("r", "g", "b") - F.least("r", "g", "b")
    grey = pixels.withColumn("grey", F.rint(0.299 * F.col("r") + 0.587 * F.col("g") + 0.114 * F.col("b")))
    named = classify.classify(grey, ["grey"], greys, max_distance=layer.get("max_distance", 20.0))
    return named.select("y", "x", F.when(spread <= layer.get("max_chroma", 5), F.col("class_id")).otherwise(F.lit(0)).alias("class_id"))


@kind("continuous")
def continuous(pixels: DataFrame, layer: dict) -> DataFrame:
    stops = [(float(s["value"]), tuple(map(float, s["rgb"]))) for s in layer["stops"]]
    step = lambda c: ramps.project(c, ["r", "g", "b"], stops, worst=layer.get("max_residual"))
    return classify.by_distinct(pixels, ["r", "g", "b"], step).select("y", "x", "value")


@kind("feature_ink")
def feature_ink(pixels: DataFrame, layer: dict) -> DataFrame:
    """Pixels in an inclusive hue, saturation and value window."""
    h, s, v = colour.hsv(F.col("r"), F.col("g"), F.col("b"))
    (h0, s0, v0), (h1, s1, v1) = layer["low"], layer["high"]
    return pixels.filter(h.between(h0, h1) & s.between(s0, s1) & v.between(v0, v1)).select("y", "x", F.lit(1).alias("class_id"))


@kind("sparse_chroma_overlays")
def chroma_overlays(pixels: DataFrame, layer: dict) -> DataFrame:
    """(y, x, class_id) a row for each ink that a pixel holds."""
    white = lab_prototypes(pixels, {"legend": layer["legend"]})
    inks = [(c[1] - 128.0, c[2] - 128.0) for _, c in white]
    chroma = in_lab(pixels).withColumns({"ca": F.col("lab_a") - 128.0, "cb": F.col("lab_b") - 128.0})
    mixed = classify.unmix(chroma, "ca", "cb", inks, penalty=layer.get("penalty", 0.0), least=layer.get("least", 0.25), worst=layer.get("max_residual"), chroma=layer.get("min_chroma", 5.0))
    return mixed.select("y", "x", F.explode("inks").alias("class_id"))


def compile_plan(plan: str | dict, pixels: DataFrame) -> dict[str, DataFrame]:
    """Layer id -> raster. `exclude_layers` removes cells that earlier layers hold; `suppress_specks` and `fill_enclosed` repair."""
    doc = json.loads(plan) if isinstance(plan, str) else plan
    out: dict[str, DataFrame] = {}
    for layer in doc["layers"]:
        if layer["kind"] not in KINDS:
            raise ValueError(f"unknown kind {layer['kind']!r}")
        if layer["id"] in out:
            raise ValueError(f"layer {layer['id']!r} appears twice")
        source = pixels
        for other in layer.get("exclude_layers", []):
            source = source.join(out[other].filter("class_id > 0").select("y", "x"), ["y", "x"], "left_anti")
        made = KINDS[layer["kind"]](source, layer)
        if "suppress_specks" in layer:
            made = regions.suppress_specks(made, **layer["suppress_specks"]).drop("suppressed")
        if "fill_enclosed" in layer:
            made = regions.fill_enclosed(made, **layer["fill_enclosed"]).drop("filled")
        out[layer["id"]] = made
    return out
