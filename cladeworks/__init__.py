"""Clone-level mutation analysis of single-cell DNA data as Spark jobs."""
