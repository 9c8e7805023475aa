"""tidemart: e-commerce event analytics written as plain Spark DataFrame functions."""
