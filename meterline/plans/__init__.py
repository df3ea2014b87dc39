"""Plan shapes that several operators need: work that must survive one key holding a third of the rows."""
