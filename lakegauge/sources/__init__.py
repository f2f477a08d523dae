"""Where rows come from and go to: queue, landing area, lake tables, mapper files."""
