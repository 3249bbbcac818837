"""The nine feature and model tasks (Q2.0-Q2.8), each saved by name.

``Tables`` holds the named inputs; ``run_tasks`` computes ``task_0`` to
``task_8`` one after another and saves every result as a new version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from revlens.plans import features as FE
from revlens.plans import models as MO
from revlens.plans import products as PR
from revlens.sources.store import ResultStore


@dataclass
class Tables:
    """review (asin, overall), product (typed), product_processed (asin, title,
    category), train and test (row_key, features, overall), and the words whose
    neighbours are asked for."""

    review: DataFrame
    product: DataFrame
    product_processed: DataFrame
    train: DataFrame
    test: DataFrame
    words: Sequence[str]


TASKS: dict[str, Callable[[Tables], DataFrame]] = {
    "task_0": lambda t: PR.count_and_mean_price(t.product),
    "task_1": lambda t: PR.product_rating_stats(t.review, t.product),
    "task_2": lambda t: PR.product_flat_stats(t.product),
    "task_3": lambda t: PR.also_viewed_stats(t.product),
    "task_4": lambda t: PR.imputation_stats(t.product),
    "task_5": lambda t: FE.word_document(t.product_processed, t.words),
    "task_6": lambda t: FE.category_document(t.product_processed),
    "task_7": lambda t: MO.tree_rmse(t.train, t.test),
    "task_8": lambda t: MO.sweep_document(MO.tree_depth_sweep(t.train, t.test)),
}


def run_tasks(store: ResultStore, tables: Tables, names: Iterable[str] = TASKS) -> dict[str, int]:
    """Compute and save the named tasks; the version each was saved as."""
    return {name: store.save(TASKS[name](tables), name) for name in names}
