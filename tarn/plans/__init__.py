"""End-to-end zone jobs and the bindings of operators to the test tables."""
