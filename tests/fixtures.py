"""Hand-made source contracts with the edge cases listed in FIXTURES.md."""

from datetime import date, datetime

AS_OF = datetime(2025, 6, 15, 12, 0, 0)

TICKETS = ("id bigint, entities_id bigint, name string, date timestamp_ntz, solvedate timestamp_ntz, "
           "closedate timestamp_ntz, takeintoaccountdate timestamp_ntz, date_mod timestamp_ntz, status int, "
           "priority int, type int, itilcategories_id bigint, slas_id_ttr bigint, time_to_resolve timestamp_ntz, "
           "solve_delay_stat int, close_delay_stat int, is_deleted int")


def ts(s):
    return datetime.fromisoformat(s)


def _t(i, status, created, solved=None, due=None, priority=3, typ=1, cat=10, deleted=0, ent=1, closed=None):
    c = ts(created)
    return (i, ent, f"T{i}", c, ts(solved) if solved else None, ts(closed) if closed else None, None, c, status,
            priority, typ, cat, 1 if due else 0, ts(due) if due else None, 0, 0, deleted)


def golden_sources(spark):
    def df(schema, rows):
        return spark.createDataFrame(rows, schema)

    tickets = df(TICKETS, [
        _t(1, 5, "2025-06-01 08:00:00", "2025-06-02 08:00:00", "2025-06-02 08:00:00"),      # solved at due -> met
        _t(2, 6, "2025-06-01 08:00:00", "2025-06-02 08:00:01", "2025-06-02 08:00:00",
           closed="2025-06-03 08:00:00"),                                                   # 1 s late -> breached
        _t(3, 2, "2025-06-01 08:00:00", None, "2025-06-10 00:00:00"),                       # open and late
        _t(4, 1, "2025-06-14 12:00:30", None, "2025-06-15 15:59:00"),                       # open, due in 3h59m
        _t(5, 4, "2025-06-14 12:00:00", None, "2025-06-15 16:00:00"),                       # open, due in 4h
        _t(6, 5, "2025-05-20 08:00:00", None, "2025-06-01 00:00:00"),                       # status 5, no solvedate
        _t(7, 1, "2025-05-20 08:00:00", typ=2),                                              # no SLA; type tie
        _t(8, 6, "2025-05-20 08:00:00", "2025-05-21 08:00:00", deleted=1),                  # deleted
        _t(9, 9, "2025-04-02 08:00:00", priority=9, typ=7, cat=999),                        # unknown codes
    ])
    tickets_users = df("tickets_id bigint, users_id bigint, type int", [
        (1, 100, 1), (1, 202, 2), (1, 201, 2), (1, 203, 2),     # three technicians -> lowest id 201
        (2, 101, 1), (2, 201, 2), (3, 100, 1), (4, 100, 1), (8, 100, 1), (8, 201, 2)])
    groups = df("id bigint, name string, code string, comment string, is_assign int", [
        (1, "Suporte", "S", None, 1), (2, "Redes", "R", None, 1), (3, "Suporte", "S2", None, 0)])
    groups_tickets = df("tickets_id bigint, groups_id bigint, type int", [
        (1, 2, 2), (1, 1, 2), (2, 3, 2), (3, 2, 2), (8, 1, 2)])
    users = df("id bigint, name string, firstname string, realname string, entities_id bigint, is_active int, "
               "is_deleted int", [
                   (100, "ana", "Ana", "Souza", 1, 1, 0), (101, "bob", None, "Lima", 1, 1, 0),
                   (201, "t1", "Tec", "Um", 1, 1, 0), (202, "t2", "Tec", "Dois", 1, 1, 0),
                   (203, "t3", None, None, 1, 1, 0)])
    useremails = df("users_id bigint, email string, is_default int", [
        (100, "b@x", 1), (100, "a@x", 1), (100, "0@x", 0)])
    groups_users = df("users_id bigint, groups_id bigint", [(201, 2), (201, 3)])   # lowest id 2, lowest name 'Redes'
    itilcategories = df("id bigint, name string, completename string, level int, itilcategories_id bigint", [
        (10, "Email", "TI > Email", 2, 11), (11, "TI", "TI", 1, 0), (12, "VPN", "TI > Redes > VPN", 3, 13)])
    slas = df("id bigint, name string, type int, number_time int, definition_time string", [
        (1, "SLA 24h", 0, 24, "hour")])
    entities = df("id bigint, name string, completename string, level int, entities_id bigint", [
        (0, "Raiz", "Raiz", 0, None), (1, "Filial A", "Raiz > Filial A", 1, 0), (2, "Vazia", "Raiz > Vazia", 2, 1)])
    # changes: one change with 2 tickets x 2 items x 3 tasks (2 done) and one assignee
    changes = df("id bigint, entities_id bigint, name string, date timestamp_ntz, solvedate timestamp_ntz, "
                 "closedate timestamp_ntz, status int, priority int, urgency int, impact int, itilcategories_id bigint, "
                 "is_deleted int", [(50, 1, "C50", ts("2025-06-01 00:00:00"), None, None, 2, 3, 3, 3, 10, 0)])
    changes_users = df("changes_id bigint, users_id bigint, type int", [(50, 201, 2)])
    changes_tickets = df("changes_id bigint, tickets_id bigint", [(50, 1), (50, 2)])
    changes_items = df("id bigint, changes_id bigint, itemtype string, items_id bigint", [
        (1, 50, "Computer", 7), (2, 50, "Computer", 8)])
    changetasks = df("id bigint, changes_id bigint, state int", [(1, 50, 2), (2, 50, 2), (3, 50, 1)])
    # software: licence rows NULL / 0 / duplicated; installs via one version
    softwares = df("id bigint, name string, manufacturers_id bigint, is_helpdesk_visible int, is_deleted int", [
        (1, "A", 1, 1, 0), (2, "B", 1, 1, 0), (3, "C", 1, 1, 0), (4, "D", 1, 1, 0)])
    manufacturers = df("id bigint, name string", [(1, "M")])
    softwarelicenses = df("id bigint, softwares_id bigint, number int, allow_overquota int, expire date, serial string, "
                          "softwarelicensetypes_id bigint", [
                              (1, 1, None, 0, None, "s", 1), (2, 2, 0, 0, None, "s", 1),
                              (3, 3, 4, 0, date(2025, 6, 15), "s", 1), (4, 3, 4, 0, date(2025, 6, 15), "s", 1),
                              (5, 4, 10, 0, date(2025, 6, 14), "s", 1)])
    softwareversions = df("id bigint, softwares_id bigint, name string", [(1, 1, "v"), (2, 2, "v"), (3, 3, "v"),
                                                                          (4, 4, "v")])
    isv = [(i, 3, "Computer", i, 0) for i in range(1, 4)] + [(10 + i, 4, "Computer", i, 0) for i in range(9)]
    isv += [(99, 4, "Computer", 99, 1)]                                    # deleted install ignored
    items_softwareversions = df("id bigint, softwareversions_id bigint, itemtype string, items_id bigint, "
                                "is_deleted int", isv)
    ticketsatisfactions = df("id bigint, tickets_id bigint, date_answered timestamp_ntz, satisfaction int, "
                             "satisfaction_scaled_to_5 double, comment string", [
                                 (1, 1, ts("2025-06-05 00:00:00"), 5, 5.0, None),
                                 (2, 8, ts("2025-06-05 00:00:00"), 2, 2.0, "ruim"),   # deleted ticket kept
                                 (3, 2, None, None, None, None)])
    return {
        "tickets": tickets, "tickets_users": tickets_users, "groups": groups, "groups_tickets": groups_tickets,
        "users": users, "useremails": useremails, "groups_users": groups_users, "itilcategories": itilcategories,
        "slas": slas, "entities": entities, "changes": changes, "changes_users": changes_users,
        "changes_tickets": changes_tickets, "changes_items": changes_items, "changetasks": changetasks,
        "softwares": softwares, "manufacturers": manufacturers, "softwarelicenses": softwarelicenses,
        "softwareversions": softwareversions, "items_softwareversions": items_softwareversions,
        "ticketsatisfactions": ticketsatisfactions,
    }
