"""Run every registered query, write its final (adaptive) physical plan to
a file and print a one-line summary per query (shuffle and broadcast
stages actually run, reused exchanges, join strategies, top-k limits):
``python tests/show_plans.py [sf_dir] [out_file]``.  Queries that fit a
model while being built are skipped (their plans are scoring only)."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from revlens.session import local_session  # noqa: E402

FITTING = {"word2vec_vocabulary", "word_synonyms", "tree_rmse", "tree_depth_sweep",
           "category_index", "category_onehot_mean", "category_pca_mean"}


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out_path = argv[2] if len(argv) > 2 else "plans.txt"
    spark = local_session(8)
    with open(out_path, "w") as out:
        for k, q in E.queries().items():
            if k in FITTING:
                continue
            df = q(spark, sf)
            df.collect()  # run it: explain then shows the final adaptive plan
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain(mode="formatted")
            out.write(f"==== {k}\n{buf.getvalue()}\n")
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain()
            p = buf.getvalue().split("== Initial Plan ==")[0]
            stages = set(re.findall(r"(Shuffle|Broadcast)QueryStage (\d+)", p))
            shuffles = sum(1 for kind, _ in stages if kind == "Shuffle")
            reused = p.count("ReusedExchange")
            joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", p)))
            print(f"{k:28s} shuffle-stages={shuffles:2d} broadcasts={len(stages) - shuffles} "
                  f"reused={reused} joins={','.join(joins) or '-'}"
                  f"{' window-group-limit' if 'WindowGroupLimit' in p else ''}")


if __name__ == "__main__":
    main(sys.argv)
