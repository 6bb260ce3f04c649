"""Source layouts of the weather dataset (positions are 1-based, in bytes)."""

# Fixed-width layout of the station list, name -> (position, length).
STATION_LAYOUT = {
    "station_id": (1, 11),
    "latitude": (13, 8),
    "longitude": (22, 9),
    "elevation": (32, 6),
    "state": (39, 2),
    "name": (42, 30),
    "gsn_flag": (73, 3),
    "hcn_crn_flag": (77, 3),
    "wmo_id": (81, 5),
}

# Fixed-width layout of the station inventory.
INVENTORY_LAYOUT = {
    "station_id": (1, 11),
    "latitude": (13, 8),
    "longitude": (22, 9),
    "element": (32, 4),
    "first_year": (37, 4),
    "last_year": (42, 4),
}

# Fixed values: "code name" lines of the country and state lists.
CODE_NAME_REGEXP = "^(.{2}) (.+)$"
