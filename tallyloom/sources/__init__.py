"""Reading and writing of the tables that the operators work on."""
