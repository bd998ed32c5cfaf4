from freightlens.plans.bucketing import store_bucketed, store_ranges  # noqa: F401
from freightlens.plans.joins import join_dims  # noqa: F401
from freightlens.plans.materialize import write_checkpoint_table  # noqa: F401
from freightlens.plans.ranking import bucketed_rank, range_rank  # noqa: F401
