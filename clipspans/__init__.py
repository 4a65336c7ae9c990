"""clipspans: Spark jobs for vehicle-trajectory recordings."""
