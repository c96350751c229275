"""Fixed values of the blocklist domain, kept in one place."""

# Categories and the topics they are published to.
MALWARE = "malware"
ADS_TRACKERS = "ads_trackers"
TOPICS = {
    "malware": "malware_domains",
    "ads_trackers": "ads_trackers_domains",
}

# Length of a domain name, and last labels that are never accepted.
MIN_DOMAIN_LENGTH = 4
MAX_DOMAIN_LENGTH = 253
REJECTED_LAST_LABELS = [
    "localhost",
    "local",
    "localdomain",
    "test",
    "example",
    "invalid",
    "onion",
    "i2p",
]
VALIDATION_ERROR = "Invalid domain format"

# The default list sources.
DEFAULT_SOURCES = {
    "stevenblack": {
        "url": "https://raw.githubusercontent.com/StevenBlack/hosts/master/hosts",
        "format": "hosts",
        "category": "ads_trackers",
        "update_frequency": "daily",
        "description": "StevenBlack's unified hosts file for ads and trackers",
    },
    "urlhaus": {
        "url": "https://malware-filter.gitlab.io/malware-filter/urlhaus-filter-agh.txt",
        "format": "adblock",
        "category": "malware",
        "update_frequency": "12hours",
        "description": "URLhaus malware domains",
    },
    "1hosts": {
        "url": "https://badmojr.gitlab.io/1hosts/Lite/adblock.txt",
        "format": "adblock",
        "category": "ads_trackers",
        "update_frequency": "daily",
        "description": "1Hosts Lite - ads and trackers",
    },
    "adwars": {
        "url": "https://raw.githubusercontent.com/jdlingyu/ad-wars/master/hosts",
        "format": "hosts",
        "category": "ads_trackers",
        "update_frequency": "daily",
        "description": "Ad-Wars hosts file",
    },
}

# Intervals, windows and limits.
ACTIVE_DAYS = 7
COMPACT_EVERY_BATCHES = 100
VACUUM_RETENTION_HOURS = 168
TRIGGERS = {"bronze": "5 seconds", "silver": "10 seconds", "gold": "30 seconds"}
FRESHNESS_MINUTES = {"bronze": 30, "silver": 60, "gold": 120}

# Consumer and producer options of the message transport.
KAFKA_CONSUMER = {
    "kafka.session.timeout.ms": "30000",
    "kafka.request.timeout.ms": "40000",
    "kafka.max.poll.interval.ms": "300000",
    "kafka.max.poll.records": "500",
    "kafka.fetch.max.wait.ms": "500",
    "kafka.fetch.min.bytes": "1024",
}
KAFKA_PRODUCER = {
    "kafka.acks": "all",
    "kafka.compression.type": "gzip",
    "kafka.batch.size": "1000",
    "kafka.linger.ms": "100",
    "kafka.retries": "3",
}
