"""Table jobs and query plans: silver, gold, marts, serving, conformance."""
