"""Writers: landing folders, bronze tables, marks, metrics and the alert outbox."""
