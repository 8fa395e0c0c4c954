"""Tables on shared storage, snapshot files, small dimensions and test-data views."""
