"""Print the plan of a registered query.

python -m jobledger.plans.explain <query> [sf_dir] [--run]

Without ``--run`` the plan is the one before execution (AQE decisions still
open); with ``--run`` that very plan runs first and is printed as it ended.
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> None:
    if not argv:
        print(__doc__)
        return
    from jobledger.catalog import QUERIES
    from jobledger.session import get_session

    name = argv[0]
    sf_dir = next((a for a in argv[1:] if not a.startswith("--")), "/root/testdata/sf0.01")
    spark = get_session()
    df = QUERIES[name](spark, sf_dir)
    if "--run" in argv:
        print(executed(df))
    else:
        df.explain("formatted")


def executed(df) -> str:
    """Run ``df`` and give the plan that ran: the final one of adaptive
    execution."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    text = plan.toString()
    return text.split("== Initial Plan ==")[0] if "== Final Plan ==" in text else text


if __name__ == "__main__":
    main(sys.argv[1:])
