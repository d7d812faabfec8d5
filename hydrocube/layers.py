"""Layer registries: declared native layers and derived ones, as column builders."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import pixels as px

Derive = Callable[[Mapping[str, Column], dict], Column]
RESAMPLING = ("nearest", "average", "mode", "max", "min", "med", "q1", "q3", "bilinear", "cubic")
AGGREGATIONS = ("nanmean", "mean", "mode", "max", "masked_max", "masked_or", "all_true", "majority")


class Columns(dict):
    """Named columns; asking for one that is absent lists what there is."""

    def __missing__(self, name: str):
        raise KeyError(f"layer {name!r} is not available; there are {sorted(self)}")


@dataclass(frozen=True)
class Layer:
    name: str
    source: str
    kind: str
    dtype: str
    nodata: int | None
    resampling: str
    aggregation: str
    inputs: tuple[str, ...] = ()
    codes: Mapping[int, str] = field(default_factory=dict)
    derive: Derive | None = None

    def __post_init__(self):
        if self.resampling not in RESAMPLING or self.aggregation not in AGGREGATIONS:
            raise ValueError(f"layer {self.name}: unknown resampling {self.resampling!r} or aggregation {self.aggregation!r}")

    def column(self, columns: Mapping[str, Column], **params) -> Column:
        """The layer's expression over native columns."""
        have = Columns(columns)
        return (self.derive(have, params) if self.derive else have[self.name]).alias(self.name)

    @property
    def metadata(self) -> dict:
        return {"nodata": self.nodata, "resampling": self.resampling, "aggregation": self.aggregation, "kind": self.kind}


class Registry:
    """The layers of one source, in order; names are unique across kinds."""

    def __init__(self, source: str):
        self.source, self.layers = source, {}

    def add(self, layer: Layer) -> Layer:
        if layer.name in self.layers:
            raise ValueError(f"layer {layer.name!r} is registered twice for {self.source!r}")
        self.layers[layer.name] = layer
        return layer

    def native(self, name: str, *, nodata: int | None, resampling: str = "nearest", aggregation: str = "mode", codes: Mapping[int, str] | None = None) -> Layer:
        return self.add(Layer(name, self.source, "native", "int", nodata, resampling, aggregation, codes=codes or {}))

    def derived(self, name: str, *, inputs: tuple[str, ...], nodata: int | None, resampling: str = "mode", aggregation: str = "mode", dtype: str = "int") -> Callable[[Derive], Derive]:
        """Registers the decorated builder: (columns, params) to a column."""

        def keep(build: Derive) -> Derive:
            self.add(Layer(name, self.source, "derived", dtype, nodata, resampling, aggregation, inputs, derive=build))
            return build

        return keep

    def of_kind(self, kind: str) -> list[Layer]:
        return [x for x in self.layers.values() if x.kind == kind]

    def derive_all(self, df: DataFrame, natives: Mapping[str, str], names: list[str] | None = None, **params) -> DataFrame:
        """df with every derivable layer (or those named) of its native columns; natives maps layer to column."""
        columns = {k: F.col(v) for k, v in natives.items()}
        wanted = [x for x in self.of_kind("derived") if (x.name in names if names else set(x.inputs) <= set(columns))]
        return df.select("*", *(x.column(columns, **params).alias(x.name, metadata={k: v for k, v in x.metadata.items() if v is not None}) for x in wanted))


REGISTRIES: dict[str, Registry] = {s: Registry(s) for s in ("viirs", "modis", "gfm")}
VIIRS, MODIS, GFM = REGISTRIES.values()

#: The meaning of each raw code.
VIIRS_CODES = {1: "fill", 15: "unquantified flood", 16: "bare land", 17: "vegetation", 20: "snow or ice", 27: "ice", 30: "cloud", 38: "mixed water", 50: "shadow", 99: "normal water"} | {c: f"{c - 100} % water" for c in range(100, 201)}
MODIS_CODES = {0: "dry", 1: "surface water", 2: "recurring flood", 3: "unusual flood", 255: "insufficient data"}

VIIRS.native("raw", nodata=1, codes=VIIRS_CODES)
MODIS.native("raw", nodata=255, codes=MODIS_CODES)
#: The count layers that the product carries; total counts have no cloud-screened form.
for _days in (1, 2, 3):
    for _name in ("TotalCounts", "ValidCounts", "WaterCounts", "WaterCountsCS") if _days > 1 else ("TotalCounts", "ValidCounts", "WaterCounts"):
        MODIS.native(f"{_name}_{_days}Day", nodata=255, resampling="average", aggregation="mean")
for _name in ("ensemble_flood_extent", "ensemble_water_extent", "reference_water_mask", "exclusion_mask"):
    GFM.native(_name, nodata=255, aggregation="masked_max")
GFM.native("ensemble_likelihood", nodata=255, resampling="average", aggregation="masked_max")
GFM.native("advisory_flags", nodata=255, aggregation="masked_or")


def _excluded(params: dict) -> list[int]:
    return px.excluded_codes(params.get("categories", px.VIIRS_DEFAULT), params.get("extra_codes", ()))


for _name, _water in (("water_fraction", True), ("flood_fraction", False)):
    VIIRS.derived(_name, inputs=("raw",), nodata=None, resampling="average", aggregation="nanmean", dtype="double")(lambda c, p, w=_water: px.viirs_fraction(c["raw"], _excluded(p), w))
VIIRS.derived("exclusion_mask", inputs=("raw",), nodata=0, aggregation="all_true")(lambda c, p: px.viirs_mask(c["raw"], _excluded(p)))
VIIRS.derived("reference_water", inputs=("raw",), nodata=0, aggregation="majority")(lambda c, p: px.viirs_mask(c["raw"], (px.VIIRS_WATER,)))
for _name, _codes in (("cloud_mask", (30,)), ("snow_ice", (20,)), ("shadow", (50,))):
    VIIRS.derived(_name, inputs=("raw",), nodata=0)(lambda c, p, k=_codes: px.viirs_mask(c["raw"], k))
for _name, _codes in (("water_fraction", (1, 2, 3)), ("flood_fraction", (3,))):
    MODIS.derived(_name, inputs=("raw",), nodata=None, resampling="average", aggregation="nanmean", dtype="double")(lambda c, p, k=_codes: px.modis_fraction(c["raw"], k))
for _name, _codes in (("exclusion_mask", (255,)), ("reference_water", (1, 2)), ("recurring_flood", (2,))):
    MODIS.derived(_name, inputs=("raw",), nodata=0)(lambda c, p, k=_codes: px.modis_mask(c["raw"], k))
for _name, _count in (("water_fraction", "water_count"), ("flood_fraction", "flood_count")):
    GFM.derived(_name, inputs=(_count, "valid_count"), nodata=None, resampling="average", aggregation="nanmean", dtype="double")(lambda c, p, k=_count: px.fraction_from_count(c[k], c["valid_count"]))
GFM.derived("reference_water", inputs=("reference_water_mask",), nodata=255, resampling="nearest", aggregation="masked_max")(lambda c, p: c["reference_water_mask"])


def find_layer(name: str, source: str | None = None) -> Layer | None:
    """The named layer, of the preferred source if that has it."""
    order = ([source] if source in REGISTRIES else []) + list(REGISTRIES)
    return next((REGISTRIES[s].layers[name] for s in order if name in REGISTRIES[s].layers), None)


def resampling_for(name: str, source: str | None = None, override: Mapping[str, str] | None = None, default: str = "average") -> str:
    if override and name in override:
        return override[name]
    found = find_layer(name, source)
    return found.resampling if found else default


def layer_table(spark: SparkSession) -> DataFrame:
    """Discovery: one row for each registered layer."""
    rows = [(x.source, x.name, x.kind, x.dtype, x.nodata, x.resampling, x.aggregation, list(x.inputs)) for r in REGISTRIES.values() for x in r.layers.values()]
    return spark.createDataFrame(rows, "source string, name string, kind string, dtype string, nodata int, resampling string, aggregation string, inputs array<string>")


def layer_docs() -> str:
    """The layer catalogue as Markdown."""
    out = ["# Layers"]
    for r in REGISTRIES.values():
        out += ["", f"## {r.source}", "", "| layer | kind | nodata | resampling | aggregation | inputs |", "|-|-|-|-|-|-|"]
        out += [f"| {x.name} | {x.kind} | {'' if x.nodata is None else x.nodata} | {x.resampling} | {x.aggregation} | {', '.join(x.inputs)} |" for x in r.layers.values()]
    return "\n".join(out) + "\n"
