"""Patent archives -> typed columns -> energy classifier, as Spark jobs."""
