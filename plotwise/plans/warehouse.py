"""A set of source tables and the models built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from importlib import import_module
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.functions.logic import today_column
from plotwise.operators.filters import active
from plotwise.session import settle

MODELS: dict[str, Callable[["Warehouse"], DataFrame]] = {}
MODULES = (
    "parcels", "sales", "values", "characteristics", "locations", "proximity", "census", "spatial_layers",
    "reporting", "ratios", "model_inputs", "open_data", "valuation", "quality",
)

# Lists of codes and their words: bounded whatever the number of parcels, so that each join broadcasts them.
CODE_LISTS = (
    "class_dict", "spatial.township", "cdu", "sale.deed_type", "htpar_reascd", "aprval_reascd", "infl_reascd", "permit_job_code", "permit_improvement_code",
    "commercial_major_subclass", "commercial_minor_subclass", "commercial_model_group", "tax.eq_factor", "location.municipality_crosswalk",
)


def model(name: str):
    """Register a model under its table name."""

    def wrap(fn: Callable[["Warehouse"], DataFrame]):
        if name in MODELS:
            raise ValueError(f"{name} is registered twice")
        MODELS[name] = fn
        return fn

    return wrap


@dataclass(frozen=True)
class Settings:
    """Codes of the assessment system that models compare with; set them to those of your tables."""

    mailed: str = "ASSRVALUE"
    certified: str = "ASSRFINAL"
    board: str = "BORVALUE"
    final_eav: str = "FINALEAV"
    cell_ft: float = 2640.0

    @property
    def stages(self) -> tuple[str, str, str]:
        return self.mailed, self.certified, self.board


@dataclass
class Warehouse:
    """Sources by name (a DataFrame, or a function that gives one) and lazily built models.

    Tables of the assessment system go by their bare name ("pardat"), others as "schema.table", and code lists
    by their name ("class_dict"). ``today`` fixes the date for repeatable runs. With ``store_tables`` each model
    that is a table is written to the checkpoint folder when first used, so that later models start from it.
    """

    spark: SparkSession
    sources: Mapping[str, DataFrame | Callable[[], DataFrame]]
    today: str | None = None
    settings: Settings = field(default_factory=Settings)
    store_tables: bool = False
    built: dict[str, DataFrame] = field(default_factory=dict)

    def src(self, name: str) -> DataFrame:
        found = self.sources[name]
        frame = found() if callable(found) else found
        return F.broadcast(frame) if name in CODE_LISTS else frame

    def active(self, name: str, drop_test_class: bool = False) -> DataFrame:
        return active(self.src(name), class_col="class" if drop_test_class else None)

    def ref(self, name: str) -> DataFrame:
        """A model, or a source of the same name that stands in for it."""
        if name not in self.built:
            if name in self.sources:
                self.built[name] = self.src(name)
            else:
                load_models()
                frame = MODELS[name](self)
                # Views are named "vw_…"; everything else is a table that is worth writing once.
                table = not name.split(".", 1)[1].startswith("vw_")
                self.built[name] = settle(frame) if self.store_tables and table else frame
        return self.built[name]

    def prepare(self, names: Iterable[str]) -> None:
        """Build models that are read next. None of them needs another first, so a build may make them at the same time."""
        for name in names:
            self.ref(name)

    def date(self) -> Column:
        return today_column(self.today)


def load_models() -> dict[str, Callable[[Warehouse], DataFrame]]:
    for name in MODULES:
        import_module(f"plotwise.plans.{name}")
    return MODELS


def attach(
    df: DataFrame, right: DataFrame, on: dict[str, str] | list[str], cols: dict[str, str] | list[str], how: str = "left"
) -> DataFrame:
    """Join ``right`` by ``left column → right column`` pairs and add some of its columns under given names."""
    pairs = on if isinstance(on, dict) else {c: c for c in on}
    named = cols if isinstance(cols, dict) else {c: c for c in cols}
    keys = {r: f"_j_{r}" for r in pairs.values()}
    slim = right.select(*[F.col(r).alias(k) for r, k in keys.items()], *[F.col(c).alias(n) for c, n in named.items()])
    clash = [n for n in named.values() if n in df.columns]
    base = df.drop(*clash)
    cond = reduce(and_, [base[left] == slim[keys[r]] for left, r in pairs.items()])
    return base.join(slim, cond, how).drop(*keys.values())


PIN_YEAR = {"pin": "parid", "year": "taxyr"}
PAR_KEYS = {"parid": "parid", "taxyr": "taxyr"}
