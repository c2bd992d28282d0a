"""Plan shapes Spark does not pick by itself: distributed ordered scans,
global ranks, exact percentiles and gap-filling grids."""
