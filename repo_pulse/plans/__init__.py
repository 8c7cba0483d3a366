"""Query catalog (one entry per operator), its SQL oracle, and batch jobs."""
