"""Names and addresses in sentences of several languages that the test tables don't hold: precision and recall.

Each text of NAMES and ADDRESSES holds that kind of datum; those of NEITHER hold none. Counted are texts, as in p3_found.
The first measurement, before patterns were changed for these sentences, gave names a recall of 0.878 and a precision of
1.000, addresses 0.967 and 0.906. The lists under LATER were written after that change, and no pattern was changed for them.
"""

import pytest

from colloqua.llm.personal import find_spans, mask

NAMES = [
    "Best regards, John Smith", "Kind regards,\nMaria O'Connor", "张伟说他来不了", "我是李娜，明天见", "my name is José García", "Ich heiße Hans Müller", "Je m'appelle Marie Dupont",
    "меня зовут Иван Петров", "Mr. Robert Brown called again", "Please contact Anna Kowalska about the invoice", "I met Peter van Dyke at the station", "Hello, I'm Susan Clark.", "王建国告诉我会议取消了",
    "这位是陈晓明，新来的同事", "请把钥匙给刘洋，谢谢", "赵丽颖请假了", "患者张敏，女，45岁", "Mein Name ist Jürgen Weiß.", "Frau Katharina Schäfer wartet schon", "Herr Thomas Becker ist da",
    "Cordialement,\nPierre Lefèvre", "Madame Claire Fontaine vous attend", "Me llamo Lucía Fernández", "Soy Carlos Ramírez, de la oficina", "Saludos,\nPedro Sánchez", "С уважением, Анна Смирнова",
    "Его зовут Сергей Иванов", "Emily Davis said she would be late", "John Miller's phone is broken", "I spoke to Dr. Alan Grant yesterday", "Regards\nTimothy Dalton", "张伟和我一起去", "孙丽的电话打不通",
    "Sincerely, Laura Palmer", "ask for Kevin Durant at the desk", "call me Alice Cooper", "Name: Núria Vidal", "我叫欧阳明，请多关照", "联系人：周杰", "收件人：吴秀英 13800138000", "司马光今天没来",
    "tell Michael Scott that the meeting moved", "Dear Helen Troy, thank you", "signed, George Washington", "郭靖老师今天讲得很好", "朋友林志玲，你见过吗", "我是杨紫，你好", "认识黄磊吗", "Danke, Ihr Karl Schmidt",
]
ADDRESSES = [
    "Hauptstraße 5, Berlin", "12 rue de Rivoli, Paris", "Ich wohne in der Lindenallee 12", "Kurfürstendamm 101, 10711 Berlin", "Meine Adresse: Am Alten Markt, Gartenweg 7b", "Schillerplatz 3", "25 avenue des Champs-Élysées",
    "j'habite 8 bis boulevard Voltaire, 75011 Paris", "3, place de la République", "Calle Mayor 12, Madrid", "vivo en la avenida de América, 45", "Plaza de España 7", "ул. Ленина, д. 10, кв. 5", "улица Пушкина, дом 3",
    "живу на проспект Мира 25", "221b Baker Street", "I live at 10 Downing Street, London", "742 Evergreen Terrace", "北京市朝阳区建国路88号", "寄到中山大道120号3栋501室", "Paseo de Gracia, 43", "Невский проспект 12",
    "5 impasse du Moulin", "Goethestr. 14", "350 Fifth Avenue", "18 Oak Lane, Springfield", "深圳市南山区科技路1号", "16 chemin des Vignes", "C/ Alcalá 20", "Bahnhofsstrasse 1",
]
NEITHER = [
    "Dear Customer Service,", "dear All Users", "This is Very Important", "方法今天学了", "任务明天交", "Happy New Year to all", "I am Very Happy", "Best regards, The Team", "Call Customer Support now", "This is Machine Learning",
    "周末去哪里玩", "马路上有很多车", "高速堵车了", "我是学生，你呢", "这是金属的吗", "New York is big", "United States of America", "Ich bin sehr müde", "Je suis très content", "soy muy feliz", "меня зовут туда", "路上小心",
    "走了3里路", "12 apples and 3 pears", "in 5 minutes", "I have 2 dogs", "the ring 5 is gone", "es sind 3 Wege", "20 place settings", "page 12 of the guide", "chapter 3, line 4", "2024年3月10日", "第3号文件", "我在路上3分钟到",
    "Windows 11 Update failed", "Python 3 Course starts Monday", "Deep Learning said the model", "黄金今天涨了", "温度明天会降", "文件我发给你了", "许多人说好", "安排一下明天的会议", "谢谢老师", "石头剪刀布", "包子来了", "关于说明",
    "陆续来了很多人", "my name is on the list", "this is it", "ask for help", "Tuesday March 5", "Kind regards", "bitte weg 3 davon", "Weg damit", "Route 66 is long", "Level 5 Boss", "Good Morning Everyone", "from Monday to Friday",
]

LATER_NAMES = [
    "Yours truly, Edward Norton", "Thanks, Olivia Bennett", "Hi, I'm Graham Norton and I need a plumber", "陈思远昨天没来上班", "我是周浩然，昨天打过电话", "请转告孙志强明早开会", "联系人：吴晓燕", "Sebastian Vettel asked for the keys",
    "Ich bin Stefan Krüger.", "Viele Grüße, Monika Lehmann", "Monsieur Antoine Girard est absent", "Je suis Camille Laurent, votre voisine", "Mi nombre es Andrés Gutiérrez", "Señora Isabel Moreno, buenos días", "Меня зовут Ольга Кузнецова",
    "С уважением, Дмитрий Соколов", "Prof. Henry Jones will lecture", "email Natalie Portman about the tickets", "Name: 诸葛瑾", "黄志明的手机关机了", "Walter White's address changed", "met with Susan Boyle today", "杨过跟我说好了", "Dear Rebecca Hall,",
]
LATER_ADDRESSES = [
    "Mozartstraße 22", "Rosenweg 4a, 50667 Köln", "77 rue Victor Hugo", "14 quai de la Rapée, Paris", "Avenida de la Constitución 3", "Calle del Pez, 9", "ул. Гагарина 14", "проспект Вернадского, д. 86", "Unter den Linden Allee 5", "90 Station Road",
    "Flat 3, 12 Mill Lane", "杭州市西湖区文三路259号", "1600 Pennsylvania Avenue", "Am Berliner Platz 2", "6 allée des Tilleuls", "Ronda de Sant Pere, 17",
]
LATER_NEITHER = [
    "With Great Pleasure", "Sent from My Phone", "The Great Wall is long", "I am from North Carolina", "Best Practices for Teams", "From Paris to Berlin", "周五一起吃饭吗", "任意选一个", "安静点", "高度怎么调", "白菜涨价了", "程序崩了", "牛奶喝完了",
    "Je suis d'accord", "Ich bin im Büro", "soy de Madrid", "5 Sterne Hotel", "3 courses left", "Platz 3 ist frei", "我们在左边等", "10 square meters", "the weather is nice", "Team Meeting moved to Monday", "黄瓜和西红柿", "万一下雨呢", "方案明天定",
]


def score(kind, positives, neither):
    hit = [t for t in positives if kind in {k for k, _, _ in find_spans(t)}]
    false = [t for t in neither if kind in {k for k, _, _ in find_spans(t)}]
    return len(hit) / len(positives), len(hit) / max(1, len(hit) + len(false)), [t for t in positives if t not in hit], false


@pytest.mark.parametrize("kind, positives, neither", [
    ("name", NAMES, NEITHER + ADDRESSES), ("address", ADDRESSES, NEITHER + NAMES),
    ("name", LATER_NAMES, LATER_NEITHER + LATER_ADDRESSES), ("address", LATER_ADDRESSES, LATER_NEITHER + LATER_NAMES)])
def test_unseen(kind, positives, neither):
    recall, precision, missed, false = score(kind, positives, neither)
    print(kind, f"recall {recall:.3f} precision {precision:.3f}", missed, false)
    assert recall >= 0.9 and precision >= 0.9, (recall, precision, missed, false)


def test_offsets_of_unseen():
    assert mask("Best regards, José García, Hauptstraße 5") == "Best regards, [NAME], [ADDRESS]"
    assert mask("меня зовут Иван Петров, ул. Ленина, д. 10") == "меня зовут [NAME], [ADDRESS]"
    assert mask("张伟说他来不了") == "[NAME]说他来不了"
