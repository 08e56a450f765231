"""End-to-end job, registered queries with their SQL twins, plan inspection."""
