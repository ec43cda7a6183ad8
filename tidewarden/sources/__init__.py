"""Reading the inputs, and writing and reading the tables of a run."""
