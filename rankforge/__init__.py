"""rankforge: binary-outcome tabular scoring and analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus column names / parameters) and
returns a DataFrame.  Nothing is collected to the driver except bounded
metadata (quantile split points, a handful of scalars, lattice winners).
"""

from rankforge.session import get_session, scratch_path, checkpoint_dir

__all__ = ["get_session", "scratch_path", "checkpoint_dir"]
