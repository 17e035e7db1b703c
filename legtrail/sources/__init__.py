"""Files in and out: drifting CSV, day-partitioned stores, consolidated datasets."""
