"""The reference's three applications as Spark jobs, plus the bindings of
every operator to the supplied tables (``catalog``)."""
