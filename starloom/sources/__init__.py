"""Reading inputs and writing layers."""
