"""Board questions, run validation and registered queries."""
